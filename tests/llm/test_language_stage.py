import zlib

import pytest

import corpus_pipeline
from martkit.llm import langid

EN, FR, DE, ES = ("the cat and the dog are in the house de re", "le chat et le chien sont dans la maison de re",
                  "der hund und die katze sind in dem haus", "el gato y el perro están en la casa de")


def labelled(spark, more):
    rows = [(1000 + i, t, x) for i, (t, x) in enumerate([(EN, "en"), (FR, "fr"), (DE, "de"), (ES, "es")] * 12)]
    return spark.createDataFrame([*rows, *((d, t, None) for d, t in more)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("text", [
    "De.", "RE", "the", f"{EN} {FR}", f"{EN} {FR} {DE}", f"{EN} {FR} {DE} {ES}", "the le der el", "日本語", "x 1234"])
def test_mixed_and_shared_words_stay(spark, text):
    more = [(1, text), (2, "1234 -- 5678"), (3, ""), (4, None)]
    docs = labelled(spark, more)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.where("doc_id < 1000").collect()} == {1: text}


def test_some_of_these_texts_have_a_low_score():
    m = langid.fit([EN, FR, DE, ES] * 12, ["en", "fr", "de", "es"] * 12)
    assert max(m.predict([f"{EN} {FR} {DE}"])[1]) < 0.5


def test_documents_pass_when_no_label_can_be_learned(spark):
    rows = [(1, "the cat", None), (2, "le chat", None), (3, None, None), (4, "12", None)]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1]
    for more in ([], [(held[0], EN, "en"), (held[1], FR, "fr")]):  # no label; labels in held-out rows only
        docs = spark.createDataFrame([*rows, *more], "doc_id long, text string, lang string")
        assert sorted(map(str, langid.keep_known(docs).collect())) == sorted(map(str, docs.collect()))
