"""Operator 6: language of every word and text by a linear-chain conditional random field.

The chain runs over a text's words (runs of letters, lower-cased).  A word's features are its character bigrams and
trigrams with word ends, its affixes (first and last two and three letters) and the languages in whose learned
lexicon it stands; learned transitions tie neighbouring words, so short stretches of another language in
code-switched text keep their own labels.  Forward-backward gives every word its marginal over the languages;
a text's language is the one with the largest mean marginal, and that mean is its score.

Learning uses a bounded sample (TRAIN_ROWS whole texts of each language in hash order), held on the driver: the texts are cut into runs of words that are strung together across languages, so that the
transitions see switches, and the weights are fitted by AdaGrad on the gradient that forward-backward gives.  The
model's size is fixed by its hash tables and does not grow with the data.

Inference takes whole texts.  The exact forward-backward of a long text is done in blocks: each block's matrix
product first, then the block borders, then all blocks side by side, so a text of any length costs few vector steps.

Defined results: a null text or one without letters is ``und`` with score 0, as is every text when no labelled
row can be learned from; ties go to the first language in order; repeated rows are judged each; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import U64, drop_caches, give_back, materialise, mix64, slices

UNKNOWN = "und"
TRAIN_ROWS = 200      # labelled texts of each language that are learned from, whole
SAMPLE_SALTS = 16
LEARN_TEXTS = 16      # texts whose features are made at a time in learning
LEXICON_WORDS = 2000  # words of each language's lexicon
BIGRAMS, TRIGRAMS, AFFIXES = 1 << 14, 1 << 16, 1 << 15
RUN_WORDS = (4, 40)   # words of a run between switches in training
CHAIN = 64            # words of a training chain
EPOCHS, BATCH, RATE, DECAY = 4, 256, 0.15, 1e-5
BLOCK = 48            # words of a block in inference
SCALE = 16            # steps between rescalings
PREDICT_BYTES = 1 << 17  # text predicted at a time (small arrays stay in cache)

_K = [mix64(np.array([k], U64))[0] | U64(1) for k in range(3, 13)]
_letters: dict[str, np.ndarray] = {}


def _is_letter(cp: np.ndarray) -> np.ndarray:
    if "bmp" not in _letters:
        _letters["bmp"] = np.array([chr(c).isalpha() for c in range(0x10000)])
    out = _letters["bmp"][np.minimum(cp, 0xFFFF)]
    high = np.flatnonzero(cp > 0xFFFF)
    if len(high):
        out[high] = [chr(c).isalpha() for c in cp[high].tolist()]
    return out


class Words:
    """Feature numbers of all words of some texts."""

    def __init__(self, texts: list[str | None]):
        lowered = [(t or "").lower() for t in texts]
        cp = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in lowered], dtype=np.int64) if lowered else np.zeros(0, np.int64)
        letter = _is_letter(cp)
        at = np.flatnonzero(letter)
        new = np.ones(len(at), bool)  # first letter of a word
        new[1:] = np.diff(at) > 1
        cut = np.searchsorted(at, ends[:-1])
        new[cut[cut < len(at)]] = True
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(at)))
        self.words = len(self.first)
        self.doc = np.searchsorted(at[self.first], np.append(0, ends))  # index of each text's first word (n+1)
        c = cp[at].astype(U64)
        last = np.ones(len(at), bool)
        last[:-1] = new[1:]
        end = U64(1)
        after, before = np.full(len(at), end), np.full(len(at), end)
        after[:-1] = np.where(last[:-1], end, c[1:])
        before[1:] = np.where(new[1:], end, c[:-1])
        self.bi = ((c * _K[0] + after * _K[1]) >> U64(40)) % U64(BIGRAMS)
        self.tri = ((before * _K[2] + c * _K[3] + after * _K[4]) >> U64(40)) % U64(TRIGRAMS)
        place = np.arange(len(at)) - np.repeat(self.first, self.size)
        mixed = mix64(c * _K[5] + place.astype(U64) * _K[6])
        self.name = np.add.reduceat(mixed, self.first) if self.words else np.zeros(0, U64)
        head, tail = self.first, self.first + self.size - 1

        def letter_at(index: np.ndarray) -> np.ndarray:
            inside = (index >= head) & (index <= tail)
            return np.where(inside, c[np.clip(index, 0, max(0, len(c) - 1))] if len(c) else end, end)

        p = [letter_at(head + k) for k in range(3)]
        s = [letter_at(tail - k) for k in range(3)]
        self.affix = np.stack([
            ((a * _K[7] + b * _K[8] + d * _K[9] + U64(k)) * _K[0] >> U64(40)) % U64(AFFIXES)
            for k, (a, b, d) in enumerate(((p[0], p[1], U64(0)), (p[0], p[1], p[2]), (s[0], s[1], U64(0)),
                                           (s[0], s[1], s[2])))], axis=1) if self.words else np.zeros((0, 4), U64)


def features(texts: list[str]) -> Words:
    """``Words`` of all texts, built LEARN_TEXTS at a time and held in small numbers: what a letter takes while its
    features are made is many times what they take."""
    out = object.__new__(Words)
    parts = []
    for i in range(0, max(1, len(texts)), LEARN_TEXTS):
        w = Words(texts[i:i + LEARN_TEXTS])
        w.bi, w.tri, w.affix = (x.astype(np.uint16) for x in (w.bi, w.tri, w.affix))  # all tables are that small
        parts.append(w)
    for name in ("bi", "tri", "affix", "name", "size"):
        setattr(out, name, np.concatenate([getattr(w, name) for w in parts]))
    before = np.append(0, np.cumsum([w.words for w in parts]))
    out.first, out.words = np.cumsum(out.size) - out.size, int(before[-1])
    out.doc = np.concatenate([np.zeros(1, np.int64), *(w.doc[1:] + k for w, k in zip(parts, before, strict=False))])
    return out


class LanguageModel:
    """Weights of the field.  ``lexicon`` holds sorted word names, ``member`` which languages know each."""

    def __init__(self, labels: list[str], lexicon: np.ndarray, member: np.ndarray):
        n = len(labels)
        self.labels, self.lexicon, self.member = labels, lexicon, member
        self.bi, self.tri, self.affix = (np.zeros((d, n), np.float32) for d in (BIGRAMS, TRIGRAMS, AFFIXES))
        self.known = np.zeros((n, n), np.float32)  # language of the lexicon, label
        self.move = np.eye(n, dtype=np.float64)    # transition scores
        self.bias = np.zeros(n, np.float32)

    def in_lexicon(self, w: Words) -> np.ndarray:
        out = np.zeros((w.words, len(self.labels)), np.float32)
        if len(self.lexicon) and w.words:
            pos = np.minimum(np.searchsorted(self.lexicon, w.name), len(self.lexicon) - 1)
            hit = np.flatnonzero(self.lexicon[pos] == w.name)
            out[hit] = self.member[pos[hit]]
        return out

    def emissions(self, w: Words, known: np.ndarray | None = None) -> np.ndarray:
        """Scores (words x labels)."""
        if not w.words:
            return np.zeros((0, len(self.labels)))
        grams = np.add.reduceat(self.bi[w.bi] + self.tri[w.tri], w.first, axis=0)
        lex = self.in_lexicon(w) if known is None else known
        return (grams + self.affix[w.affix].sum(axis=1) + lex @ self.known + self.bias).astype(np.float64)

    def marginals(self, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """P(label of a word | its text), exactly, for texts given by the index of their first word (n+1)."""
        n = len(self.labels)
        if not len(score):
            return np.zeros((0, n))
        move = np.exp(self.move - self.move.max())
        psi = np.exp(score - score.max(axis=1, keepdims=True))
        words = np.diff(doc)
        blocks = -(-words // BLOCK)
        first = np.cumsum(blocks) - blocks
        total = int(blocks.sum())
        home = np.repeat(np.arange(len(words)), words)
        inside = np.arange(len(score)) - doc[home]
        row, col = first[home] + inside // BLOCK, inside % BLOCK
        grid = np.ones((BLOCK, total, n))
        grid[col, row] = psi
        size = np.bincount(row, minlength=total)
        is_first = np.zeros(total, bool)
        is_first[first[words > 0]] = True
        # product of each block's matrices (a text's first word has no transition)
        prod = np.broadcast_to(np.eye(n), (total, n, n))
        least = int(size.min())  # steps that every block has
        for s in range(int(size.max())):
            step = (prod.reshape(-1, n) @ move).reshape(total, n, n)
            if s == 0:
                step[is_first] = prod[is_first]
            step *= grid[s][:, None, :]
            if s % SCALE == SCALE - 1:
                step /= step.max(axis=(1, 2), keepdims=True)
            prod = step if s < least else np.where((size > s)[:, None, None], step, prod)
        prod /= prod.max(axis=(1, 2), keepdims=True)
        # borders: entry of every block from the left, exit from the right
        entry, leave = np.ones((total, n)), np.ones((total, n))
        longest = int(blocks.max())
        for k in range(1, longest):
            b = first[blocks > k] + k
            v = np.einsum("bi,bij->bj", entry[b - 1], prod[b - 1])
            entry[b] = v / v.max(axis=1, keepdims=True)
        for k in range(2, longest + 1):
            b = (first + blocks)[blocks >= k] - k
            v = np.einsum("bij,bj->bi", prod[b + 1], leave[b + 1])
            leave[b] = v / v.max(axis=1, keepdims=True)
        # inside all blocks at once
        fwd = np.empty((BLOCK, total, n))
        a = entry
        for s in range(int(size.max())):
            moved = a @ move
            if s == 0:
                moved[is_first] = entry[is_first]
            a = moved * grid[s]
            if s % SCALE == SCALE - 1:
                a /= a.max(axis=1, keepdims=True)
            fwd[s] = a
        back = leave.copy()
        for s in reversed(range(int(size.max()))):
            fwd[s] *= back  # places beyond a block's end are never read
            nxt = (grid[s] * back) @ move.T
            if s % SCALE == 0:
                nxt /= nxt.max(axis=1, keepdims=True)
            back = nxt if s < least else np.where((size > s)[:, None], nxt, back)
        out = fwd[col, row]
        return out / out.sum(axis=1, keepdims=True)

    def label_words(self, text: str) -> list[tuple[str, str]]:
        """(word, language) of a text's words."""
        w = Words([text])
        best = self.marginals(self.emissions(w), w.doc).argmax(axis=1)
        low = text.lower()
        cp = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.flatnonzero(_is_letter(cp))
        return [(low[at[f]:at[f + n - 1] + 1], self.labels[b]) for f, n, b in
                zip(w.first, w.size, best, strict=True)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        w = Words(texts)
        if not self.labels or not w.words:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        p = self.marginals(self.emissions(w), w.doc)
        n = np.diff(w.doc)
        full = np.flatnonzero(n)
        mean = np.add.reduceat(p, w.doc[full], axis=0) / n[full][:, None]
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i, m in zip(full.tolist(), mean, strict=True):
            lang[i], score[i] = self.labels[int(m.argmax())], float(min(1.0, m.max()))
        return lang, score


def fit(texts: list[str], langs: list[str], seed: int = 7) -> LanguageModel:
    """Learn from whole labelled texts (all of them held in memory)."""
    labels = sorted(set(langs))
    w = features(texts)
    label_of = {x: k for k, x in enumerate(labels)}
    own = np.repeat([label_of[x] for x in langs], np.diff(w.doc)).astype(np.int64) if texts else np.zeros(0, np.int64)
    n = len(labels)
    # lexicon: the most frequent words of each language
    names, code = np.unique(w.name, return_inverse=True)
    count = np.bincount(code * n + own, minlength=len(names) * n).reshape(len(names), n) if n else np.zeros((0, 0))
    member = np.zeros((len(names), n), bool)
    for k in range(n):
        top = np.argsort(-count[:, k], kind="stable")[:LEXICON_WORDS]
        member[top, k] = count[top, k] > 1
    keep = member.any(axis=1) if n else np.zeros(0, bool)
    model = LanguageModel(labels, names[keep], member[keep].astype(np.float32))
    if n < 2 or not w.words:
        return model
    # runs of words, in random order, strung into chains
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(texts)), np.diff(w.doc))
    cuts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    border = np.zeros(w.words, bool)
    border[cuts] = True
    at = 0
    steps = rng.integers(*RUN_WORDS, size=w.words // RUN_WORDS[0] + 1)
    for s in steps.tolist():
        if at >= w.words:
            break
        border[at] = True
        at += s
    starts = np.flatnonzero(border)
    runs = np.split(np.arange(w.words), starts[1:])
    order = np.concatenate([runs[k] for k in rng.permutation(len(runs))])
    chains = -(-len(order) // CHAIN)
    known = model.in_lexicon(w)
    state: dict[str, np.ndarray] = {}

    def step(name: str, grad: np.ndarray, scale: float) -> None:
        table = getattr(model, name)
        grad = grad * scale + DECAY * table
        state[name] = state.get(name, np.full(table.shape, 1e-3, table.dtype)) + (grad * grad).astype(table.dtype)
        table -= (RATE * grad / np.sqrt(state[name])).astype(table.dtype)

    for _ in range(EPOCHS):
        shuffled = rng.permutation(chains)
        for b in range(0, chains, BATCH):
            pick = [order[c * CHAIN:(c + 1) * CHAIN] for c in shuffled[b:b + BATCH].tolist()]
            words = np.concatenate(pick)
            bounds = np.append(0, np.cumsum([len(x) for x in pick]))
            part = _subset(w, words)
            score = model.emissions(part, known[words])
            p, pairs = _chain_expectations(model, score, bounds)
            y = own[words]
            g = p.copy()
            g[np.arange(len(y)), y] -= 1.0
            scale = 1.0 / len(words)
            per_letter = np.repeat(g, part.size, axis=0)
            move = pairs.copy()
            inner = np.ones(len(y), bool)
            inner[bounds[:-1]] = False
            np.subtract.at(move, (y[np.flatnonzero(inner) - 1], y[inner]), 1.0)
            for name, index, grad in (("bi", part.bi, per_letter), ("tri", part.tri, per_letter),
                                      ("affix", part.affix.ravel(), np.repeat(g, 4, axis=0))):
                size = len(getattr(model, name))
                step(name, np.stack([np.bincount(index.astype(np.int64), grad[:, k], size) for k in range(n)], axis=1),
                     scale)
            step("known", known[words].T @ g, scale)
            step("bias", g.sum(axis=0), scale)
            step("move", move, scale)
    return model


def _subset(w: Words, words: np.ndarray) -> Words:
    """The features of chosen words, in the given order."""
    from martkit.llm.common import ragged

    out = object.__new__(Words)
    letters = ragged(w.first[words], w.size[words])
    out.size, out.words = w.size[words], len(words)
    out.first = np.cumsum(out.size) - out.size
    out.bi, out.tri, out.affix, out.name = w.bi[letters], w.tri[letters], w.affix[words], w.name[words]
    return out


def _chain_expectations(model: LanguageModel, score: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word and the expected number of each transition, over short chains."""
    n, lanes = score.shape[1], len(bounds) - 1
    size = np.diff(bounds)
    move = np.exp(model.move - model.move.max())
    home = np.repeat(np.arange(lanes), size)
    col = np.arange(len(score)) - bounds[home]
    steps = int(size.max())
    grid = np.ones((steps, lanes, n))
    grid[col, home] = np.exp(score - score.max(axis=1, keepdims=True))
    fwd = np.empty_like(grid)
    a = grid[0] / grid[0].sum(axis=1, keepdims=True)
    fwd[0] = a
    for s in range(1, steps):
        a = (a @ move) * grid[s]
        a /= a.sum(axis=1, keepdims=True)
        fwd[s] = a
    pairs = np.zeros((n, n))
    p = np.empty_like(grid)
    back = np.ones((lanes, n))
    for s in reversed(range(steps)):
        live = size > s
        both = fwd[s] * back
        p[s] = both / both.sum(axis=1, keepdims=True)
        if s:
            right = grid[s] * back
            joint = fwd[s - 1][:, :, None] * move[None] * right[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs += joint[live].sum(axis=0)
            nxt = right @ move.T
            back[live] = (nxt / nxt.sum(axis=1, keepdims=True))[live]
    return p[col, home], pairs


def fit_sample(docs: DataFrame, learn: Column) -> LanguageModel:
    """Fit on the bounded sample of the rows that satisfy ``learn`` and have a label."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", F.lit(6)).alias("h"),
        F.col("text").cast("string").alias("text"))

    def first(df: DataFrame, *by: str, order: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return df.withColumn("rank", rank).where(F.col("rank") <= TRAIN_ROWS).drop("rank")

    # the hash of each language's last sampled text: by salt first, so that no language is ranked in one task
    salted = first(rows.select("lang", "h", F.pmod("h", F.lit(SAMPLE_SALTS)).alias("salt")), "lang", "salt", order=["h"])
    last = materialise(first(salted.select("lang", "h"), "lang", order=["h"]).groupBy("lang").agg(F.max("h").alias("last")),
                       "sample-bounds")
    # rows of a repeated doc_id share a hash
    sample = first(rows.join(last, "lang").where("h <= last"), "lang", order=["h", "text"]).orderBy("lang", "h", "text").collect()
    model = fit([r["text"] for r in sample], [r["lang"] for r in sample])
    del sample
    give_back()  # else the driver holds what learning took through all that follows
    return model


_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for b in slices(batches, "text", PREDICT_BYTES):
            lang, score = model.predict(b.column("text").to_pylist())
            keep = [i for i, c in enumerate(b.schema.names) if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*(b.schema.names[i] for i in keep), "lang_pred", "score"])

    return run


def held_out(fold: int = 1, folds: int = 3) -> Column:
    """Rows that are never learned from, by crc32 of the doc_id as text (a null doc_id is never held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict every row: doc_id, held_out, lang_pred, score."""
    model = fit_sample(docs, ~held_out())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), _PREDICTED)


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that the method gives a language, whatever its score, unchanged; only ``und`` texts (no letters) go.

    The score is a mean over a text's words, so it says how mixed a text is and not whether its languages are known: a
    text in three languages or of one word that two languages share has a low one.  When no label can be learned,
    every text would be ``und`` and all documents pass.
    """
    docs = docs.withColumn("text", F.col("text").cast("string"))
    model = fit_sample(docs, ~held_out())
    if not model.labels:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for b in slices(batches, "text", PREDICT_BYTES):
            lang, _ = model.predict(b.column("text").to_pylist())
            yield b.filter(pa.array([x != UNKNOWN for x in lang]))

    return docs.mapInArrow(run, docs.schema)
