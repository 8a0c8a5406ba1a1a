"""Operator 7: glob rules over canonical URLs as one bit-parallel Shift-And automaton.

A URL's canonical text is ``.host/path``: the host with A-Z lower-cased and a leading dot, then the path.  A glob
is made of literal bytes, ``?`` (any byte but ``/``), ``*`` (any run without ``/``) and ``**`` (any run).  All globs
are packed side by side into 64-bit words, one bit per position: a byte moves every active bit one place on
where the next position takes that byte, and wildcard positions keep themselves alive.  One pass over the bytes
simulates all globs at once; the URLs of a batch advance together, longest first, so a batch costs as many
vector steps as its longest URL.

A rule is (action, host/path prefix): it fits its host and all subdomains when the URL's path starts with the
rule's path, and becomes the glob ``*.host/path**`` (a host holds no ``/``, so ``*`` covers subdomains only).  Of
the rules that fit, the longest decides; equal lengths go to block, then to the rule listed first.  URLs that no
rule fits are blocked if one of the method's own globs matches, else allowed.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed;
repeated rows are judged each; a url of any length is matched whole; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import U64, slices, text_bytes

#: The contract's rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
#: The method's own globs: paths of trackers, log-in pages and machine endpoints that hold no prose.
BLOCK_GLOBS = ("*/ads/**", "*/**/track?", "*/**/tracking/**", "*/**/login**", "*/**/signin**", "*/cgi-bin/**",
               "*/**.php", "ads.**", "*.ads.**", "*.doubleclick.*/**", "*/wp-admin/**")


class GlobAutomaton:
    """Shift-And masks of many globs; ``match`` runs them over many byte strings."""

    def __init__(self, globs: Sequence[str]):
        self.globs = list(globs)
        tokens = [self._parse(g) for g in self.globs]
        # per glob: one start bit, then one bit per token that consumes exactly one byte; a wildcard run is a
        # loop on the bit before it
        bits = sum(1 + sum(kind == "one" for kind, _ in t) for t in tokens)
        self.words = max(1, -(-bits // 64))
        take = np.zeros((256, self.words), U64)   # positions entered on this byte
        loop = np.zeros((256, self.words), U64)   # positions that stay alive on this byte
        start = np.zeros(self.words, U64)
        final: list[int] = []
        at = 0
        no_slash = [b for b in range(256) if b != 0x2F]
        for t in tokens:
            start[at // 64] |= U64(1) << U64(at % 64)
            for kind, accept in t:
                if kind == "run":
                    for b in accept or no_slash:
                        loop[b, at // 64] |= U64(1) << U64(at % 64)
                else:
                    at += 1
                    for b in accept:
                        take[b, at // 64] |= U64(1) << U64(at % 64)
            final.append(at)
            at += 1
        self.take, self.loop, self.start = take, loop, start
        self.final = np.array(final, dtype=np.int64)

    @staticmethod
    def _parse(glob: str) -> list[tuple[str, list[int]]]:
        out: list[tuple[str, list[int]]] = []
        raw, i = glob.encode("utf-8"), 0
        no_slash = [b for b in range(256) if b != 0x2F]
        while i < len(raw):
            if raw[i:i + 2] == b"**":
                out.append(("run", list(range(256))))
                i += 2
            elif raw[i:i + 1] == b"*":
                out.append(("run", no_slash))
                i += 1
            else:
                out.append(("one", no_slash if raw[i:i + 1] == b"?" else [raw[i]]))
                i += 1
        return out

    def match(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Boolean (strings x globs): which globs match which whole strings."""
        n = np.diff(offs)
        order = np.argsort(-n, kind="stable")
        begin, left = offs[:-1][order], n[order]
        state = np.repeat(self.start[None, :], len(n), axis=0)
        live = len(n)
        for step in range(int(left[0]) if len(n) else 0):
            while live and left[live - 1] <= step:
                live -= 1
            byte = data[begin[:live] + step]
            s = state[:live]
            moved = s << U64(1)
            if self.words > 1:
                moved[:, 1:] |= s[:, :-1] >> U64(63)
            state[:live] = (moved & self.take[byte]) | (s & self.loop[byte])
        hit = (state[:, self.final // 64] >> (self.final % 64).astype(U64)) & U64(1)
        out = np.empty((len(n), len(self.globs)), dtype=bool)
        out[order] = hit.astype(bool)
        return out


def rule_glob(rule: str) -> str:
    host, _, path = rule.partition("/")
    if any(c in rule for c in "*?"):
        raise ValueError(f"a rule is a plain prefix: {rule}")
    return f"*.{host}/{path}**"


_JUDGED = "page_id long, host string, path string, rule string, verdict string, globs int"


def _judge(rules: Sequence[tuple[str, str]], globs: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = GlobAutomaton([rule_glob(r) for _, r in rules] + ["." + g if g[0] not in ".*" else g for g in globs])
        # best rule first: longest, then block, then as listed
        rank = sorted(range(len(rules)), key=lambda k: (-len(rules[k][1]), rules[k][0] != "block", k))
        text = np.array([rules[k][1] for k in rank] + [None], dtype=object)
        act = np.array([rules[k][0] for k in rank] + [""], dtype=object)
        for b in slices(batches, "canonical", 1 << 19):
            hit = auto.match(*text_bytes(b.column("canonical")))
            ruled = np.concatenate([hit[:, rank], np.ones((len(hit), 1), bool)], axis=1).argmax(axis=1)
            own = hit[:, len(rules):].sum(axis=1)
            verdict = np.where(ruled < len(rules), act[ruled], np.where(own > 0, "block", "allow"))
            yield pa.RecordBatch.from_arrays([
                b.column("page_id"), b.column("host"), b.column("path"), pa.array(text[ruled], pa.string()),
                pa.array(verdict, pa.string()), pa.array(own.astype(np.int32))],
                names=["page_id", "host", "path", "rule", "verdict", "globs"])

    return run


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
                globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """Judge every url: page_id, host, path, rule, verdict and the number of the method's globs that match."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    canonical = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    return canonical.mapInArrow(_judge(tuple(rules), tuple(globs)), _JUDGED)
