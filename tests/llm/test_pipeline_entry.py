import subprocess
import sys
import zlib

import __spark_entry__ as entry
import corpus_pipeline
from martkit.llm.common import materialise, table
from martkit.llm.decontam import find_leaks
from martkit.llm.jaccard_join import jaccard_components
from martkit.llm.langid import UNKNOWN, fit_sample, held_out
from martkit.llm.secrets import ALL_CLASSES, redact
from tests.llm.util import empty, hard_docs

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_against_their_operators(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = materialise(stage(spark, before, SF), name)
        assert kept.columns == columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        rows = {r.doc_id: r for r in before.collect()}
        if name == "language":
            m = fit_sample(before, ~held_out())
            lang, _ = m.predict([r.text for r in rows.values()])
            want = {d for d, x in zip(rows, lang, strict=True) if x != UNKNOWN}
        elif name == "near_duplicates":
            want = {r.doc_id for r in jaccard_components(before, 5, 80, 100).collect() if r.doc_id == r.component_id}
        elif name == "decontamination":
            want = set(rows) - {r.doc_id for r in find_leaks(before, table(spark, SF, "benchmark")).collect()}
        else:
            want = set(rows)
            assert {r.doc_id: r.text for r in kept.collect()} == {r.doc_id: r.text for r in redact(before, classes=ALL_CLASSES).collect()}
        assert ids == want
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == ids
    again = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert zlib.crc32(str(sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)).encode()) == zlib.crc32(
        str(sorted((r.doc_id, r.piece, r.ids_crc32) for r in again)).encode())


def test_stages_take_hard_and_empty_tables(spark):
    for docs in (hard_docs(spark), empty(hard_docs(spark))):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).count()


def test_entry_imports_without_the_subpackage():
    code = ("import sys, importlib.util as u; f = u.find_spec; "
            "u.find_spec = lambda n, *a: None if n.startswith(('martkit.llm', 'corpus_pipeline')) else f(n, *a); "
            "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op1_') for n in q); "
            "assert 'pipeline' not in q and 'martkit.llm' not in sys.modules")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60)


def test_entry_keeps_the_marts_when_a_dependency_is_absent():
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert len(q) > 80 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, timeout=60)
