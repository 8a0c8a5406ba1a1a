"""Learning the languages holds little besides the texts."""

import tracemalloc

import numpy as np

from martkit.llm import langid


def test_learning_holds_little_besides_the_texts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(w) for w in rng.choice(list("abcdefghé"), (800, 5))) for _ in range(200)]
    whole, parts = langid.Words(texts), langid.features(texts)
    for name in ("bi", "tri", "affix", "name", "size", "first", "doc", "words"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name)), name
    del whole, parts
    monkeypatch.setattr(langid, "EPOCHS", 0)
    tracemalloc.start()
    langid.fit(texts, ["en", "fr"] * 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * sum(map(len, texts))
