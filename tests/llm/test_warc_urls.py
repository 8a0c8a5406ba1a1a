import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pytest

from martkit.llm import warc
from martkit.llm.common import text_bytes
from martkit.llm.url_filter import GlobAutomaton, filter_urls
from tests.llm.util import empty


def test_chunked_framing():
    rng = random.Random(1)
    for n in (0, 1, 10, 4096, 10_000):
        body = bytes(rng.randrange(256) for _ in range(n))
        assert warc.dechunk(warc.chunked(body, 1000)) == body
    assert warc.dechunk(b"3;name=x\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcX0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunk(bad)


def test_segments_are_checked():
    whole = bytes(range(256)) * 20
    parts = warc.split_record([("WARC-Record-ID", "<urn:a>")], "urn:a", whole, 1000)
    assert len(parts) == 6 and dict(parts[-1][0])["WARC-Segment-Total-Length"] == str(len(whole))
    stream = io.BytesIO(b"".join(warc.record_bytes(f, b) for f, b in parts))
    assert [b for _, b in warc.read_records(stream)] == [b for _, b in parts]
    blocks = [b for _, b in parts]
    numbers, totals = list(range(1, 7)), [None] * 5 + [len(whole)]
    assert warc.join_segments(numbers, totals, blocks) == (whole, "ok")
    assert warc.join_segments([1, 2, 4, 5, 6], [None] * 4 + [len(whole)], blocks[:2] + blocks[3:])[1] != "ok"
    assert warc.join_segments(numbers[:5], totals[:5], blocks[:5])[1] == "last segment missing"
    assert warc.join_segments(numbers, totals, [*blocks[:5], blocks[5][:-1]])[1] == "total length differs"


PAGES = [
    (3, "http://a.org/x", "same " * 40), (1, "http://a.org/y", "same " * 40), (2, None, "same " * 40),
    (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u\nv", "é" * 100_000),
    (9, "u", "é" * 100_000), (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "y" * 100), (13, "u", "y" * 100),
    (None, "u", "same " * 40),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS digest", "1 AS first", "'y' AS payload", "0 AS refers_to")
    rows = warc.warc_roundtrip(pages.repartition(3), segment=1000).collect()
    assert {r.status for r in rows} == {"ok"} and max(r.segments for r in rows) > 100
    first = {}
    for p, _, h in sorted((x for x in PAGES if x[0] is not None), key=lambda x: x[0]):
        first.setdefault(h, p)
    want = []
    for p, _, h in PAGES:
        raw = (h or "").encode()
        ref = first[h] if p is not None and len(raw) >= 100 and first[h] != p else None
        want.append((p or -1, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if ref else "response", ref))
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == \
        sorted(want)


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "z" * 5000)] * 3 + [(2, "u", "z" * 5000)],
                                  "page_id long, url string, html string")
    rows = warc.warc_roundtrip(pages, segment=1000).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.status) for r in rows) == [
        (1, "response", None, 5000, "ok")] * 3 + [(2, "revisit", 1, 5000, "ok")]
    assert warc.warc_roundtrip(empty(pages)).count() == 0


def test_archives_lost_by_other_attempts_do_not_count(spark, tmp_root):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, tmp_root)
    open(f"{tmp_root}/pages-000000-stray.warc.gz", "wb").write(b"half a file")
    assert warc.read_archives(spark, manifest).count() == 1


def fits(glob, text):
    """Dynamic programming over the parts of a glob: the set of text places that the parts so far can end at."""
    parts, i = [], 0
    while i < len(glob):
        parts.append("**" if glob.startswith("**", i) else glob[i])
        i += len(parts[-1])
    ends = {0}
    for p in parts:
        new = set()
        for at in sorted(ends):
            if p in ("*", "**"):
                while at not in new:
                    new.add(at)
                    if at == len(text) or (p == "*" and text[at] == "/"):
                        break
                    at += 1
            elif at < len(text) and (text[at] != "/" if p == "?" else text[at] == p):
                new.add(at + 1)
        ends = new
    return len(text) in ends


def test_automaton_against_dynamic_programming():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "ab"]) for _ in range(rng.randint(1, 9)))
             for _ in range(60)] + ["a****a*****ba"]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 25))) for _ in range(400)] + [
        "a" * 3000, "a" * 2990 + "/ba", "ab/" * 1000]
    auto = GlobAutomaton(globs)
    assert auto.words > 1
    got = auto.match(*text_bytes(pa.array(texts)))
    want = np.array([[fits(g, t) for g in globs] for t in texts])
    assert (got == want).all()
    assert fits("a?", "ab") and not fits("a?", "a/") and fits("**b", "a/b") and not fits("*b", "a/b")


URLS = [
    (1, "http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/12?q=1", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://example.org/en/2#x", "example.org", "/en/2", "org/", "allow"),
    (4, "http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    (5, "http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    (6, "http://x.com/DE/", "x.com", "/DE/", None, "allow"),
    (7, "http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
    (8, "http://org?x=/y", "org", "", None, "allow"),
    (9, "http://org/", "org", "/", "org/", "allow"),
    (10, None, "", "", None, "allow"),
    (11, "no scheme/at all", "", "", None, "allow"),
    (12, "http://x.net/cgi-bin/a.org/es/", "x.net", "/cgi-bin/a.org/es/", None, "block"),
    (13, "", "", "", None, "allow"),
    (14, "://", "", "", None, "allow"),
    (15, "http://x.net/" + "a" * 20_000 + "/login", "x.net", "/" + "a" * 20_000 + "/login", None, "block"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(*u[:2], "h") for u in [*URLS, URLS[0]]], "page_id long, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages).collect())
    assert got == sorted((u[0], *u[2:]) for u in [*URLS, URLS[0]])
    assert filter_urls(empty(pages)).count() == 0
