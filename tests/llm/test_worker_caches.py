"""A worker keeps the words of one operator at a time, and of those the ones it meets again."""

import gc

import pyarrow as pa
import pytest

from martkit.llm import langid, tokens
from martkit.llm.common import WordHashes, word_hashes
from martkit.llm.decontam import _clean
from martkit.llm.langid import _predict, fit
from martkit.llm.queries import tokenizer_path
from martkit.llm.tokens import WordEncoder, encoder

PATH = tokenizer_path()


def _held(kind: type) -> int:
    gc.collect()
    return sum(isinstance(x, kind) for x in gc.get_objects())


def test_the_next_operator_drops_what_the_one_before_kept():
    word_hashes(pa.array(["one two", "two three"]))
    encoder(PATH).encode(pa.array(["one two"]))
    assert (_held(WordHashes), _held(WordEncoder)) == (0, 1)
    assert encoder(PATH) is encoder(PATH)
    first = word_hashes(pa.array(["one two"]))[0].tolist()
    assert (_held(WordHashes), _held(WordEncoder)) == (1, 0)
    encoder(PATH)
    assert word_hashes(pa.array(["one two"]))[0].tolist() == first


@pytest.mark.parametrize("task", [_clean([(1, "a benchmark item of some words")], 0.1),
                                  _predict(fit(["one two three", "un deux trois"], ["en", "fr"]))])
def test_a_task_that_keeps_nothing_drops_it_too(task):
    encoder(PATH).encode(pa.array(["one two"]))
    list(task(iter([])))
    assert _held(WordEncoder) == 0


def test_a_full_cache_keeps_the_words_met_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    enc, learned = WordEncoder(PATH), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda words: (learned.extend(words), learn(words)))
    texts = ["the cat " * 3 + " ".join(f"w{i}x{k}" for k in range(15)) for i in range(12)]
    for t in texts:
        ids, first = enc.encode(pa.array([t, None, "the Ünï"]))
        want = [enc.tok.encode(x, add_special_tokens=False).ids for x in (t, "", "the Ünï")]
        assert [ids[first[i]:first[i + 1]].tolist() for i in range(3)] == want
    assert learned.count(b"the") == learned.count(b"cat") == 1
    assert len(enc.numbers) <= 40 + 17 and enc.known == len(enc.numbers)


def test_the_driver_gives_back_what_learning_took(spark, monkeypatch):
    given = []
    monkeypatch.setattr(langid, "give_back", lambda: given.append(1), raising=False)
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("one two three", "en"), ("un deux trois", "fr")] * 4)],
                                 "doc_id long, text string, lang string")
    assert langid.keep_known(docs).count() == 8
    assert given == [1]
