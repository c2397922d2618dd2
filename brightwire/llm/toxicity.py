"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and their beginnings and ends; every one is hashed to a row of a table of
``2 ** BITS`` rows, and a row counts once however often it occurs. The machine scores ``w0 + sum w_i + sum over pairs
<v_i, v_j>``, so two terms together, such as an insult and a group mention, weigh differently from their sum; a linear
model lacks that.

Fitting uses at most ``max_rows`` labelled rows (those first by a hash of doc_id, so the choice is stable) and all of their
terms; none is left out for its count or for what it says alone. ``search`` fits weights and factors of all rows together,
by follow-the-regularized-leader steps whose threshold grows with each coordinate's own noise: a coordinate is zero until
its gradients, summed, exceed ``CERTAIN`` times the root of their squares. A pair's factors get gradients of their own, so
two terms that say nothing alone survive together. ``train`` then fits the machine over the rows that aren't zero once more,
without thresholds. The driver's input is bounded by ``max_rows``; the model (some thousand rows) is broadcast; scoring
reads every whole text.

Defined results: empty and null texts have no terms and get the score of ``w0``; labels that are null are not used; a doc_id
that is labelled twice is toxic if one label says so; a labelled doc_id that several rows have is fitted once; with no labels, or
one class only, every score is the smoothed rate of that class; repeated rows get equal scores; an empty table gives no
rows; other columns, labels, lang, source and doc_id are never part of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightwire.llm.common import Bounded, cut, id_text, tidied

#: The table has 2 ** BITS rows.
BITS = 20
#: Characters of a word's beginning and of its end that are terms.
HEAD, TAIL = 4, 4
#: A coordinate is zero while its summed gradients are below this many times the root of their summed squares; that ratio
#: can't exceed the root of the rarer class's rows, of which half is asked at most.
CERTAIN = 3.0
EDGES = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
FOLDS = 5


@dataclass(frozen=True)
class Model:
    bias: float
    terms: dict[int, int]  # row of the hashed table to the place of its weight and factors; other rows are zero
    weights: np.ndarray
    factors: np.ndarray


def word_terms(chunk: str) -> set[int]:
    """Rows of the terms of a white-space-bounded piece of text."""
    import xxhash

    word = chunk.strip(EDGES).lower()
    if not word:
        return set()
    shown = [f"={word}"]
    if len(word) > HEAD:
        shown.append(f"^{word[:HEAD]}")
    if len(word) > TAIL:
        shown.append(f"{word[-TAIL:]}$")
    return {xxhash.xxh3_64_intdigest(s) >> (64 - BITS) for s in shown}


class Finder:
    """The model's rows of a text."""

    def __init__(self, terms: dict[int, int], cap: int = 200_000):
        self.terms = terms
        self.known = Bounded(self.rows, cap)

    def rows(self, chunk: str) -> tuple[int, ...]:
        return tuple(self.terms[t] for t in word_terms(chunk) if t in self.terms)

    def __call__(self, text: str) -> np.ndarray:
        found = set().union(*filter(None, map(self.known.__getitem__, set(text.split()))))
        return np.fromiter(found, np.int64, len(found))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, toxic, tie) with the sorted rows of all terms of each text in place of the text."""
    made = Bounded(word_terms, 150_000)
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            own = set().union(*map(made.__getitem__, set(text.split())))
            rows.append(np.sort(np.fromiter(own, np.int32, len(own))))
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), lists], ["doc_id", "toxic", "tie", "found"])


def raw_scores(model: Model, found: list[np.ndarray]) -> np.ndarray:
    counts = [len(f) for f in found]
    at, doc = np.concatenate([np.zeros(0, np.int64), *found]), np.repeat(np.arange(len(found)), counts)
    total = lambda x: np.bincount(doc, x, len(found))
    out = model.bias + total(model.weights[at])
    for v in model.factors.T:
        out += 0.5 * (total(v[at]) ** 2 - total(v[at] ** 2))
    return out


def probability(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def _weighing(toxic: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The rarer class weighs more."""
    return np.where(toxic == 1, np.sqrt((y == 0).sum() / y.sum()), 1.0)


def search(at: np.ndarray, counts: np.ndarray, toxic: np.ndarray, n_rows: int, k: int = 4, epochs: int = 4, batch: int = 512, rate: float = 0.3, seed: int = 17) -> np.ndarray:
    """Rows whose weight or factors aren't zero in a machine over all rows.

    ``at``: the documents' rows one after the other, ``counts`` of them each. Factors start at small random values, which
    let gradients through but aren't taken for evidence.
    """
    rng, y, n = np.random.default_rng(seed), toxic.astype(float), len(toxic)
    share, begin = _weighing(toxic, y), np.concatenate(([0], np.cumsum(counts)[:-1]))
    bias, bias_squares = 0.0, 1e-6
    w, w_sum, w_squares = np.zeros(n_rows), np.zeros(n_rows), np.zeros(n_rows)
    start = rng.normal(0, 0.01, (k, n_rows))
    v, v_sum, v_squares = start.copy(), np.zeros((k, n_rows)), np.zeros((k, n_rows))

    def step(value, total, squares, grad, grad_squares, sure, ease):
        """Coordinates after a batch; ``total`` and ``squares`` are brought up to date in place."""
        before = np.sqrt(squares)
        squares += grad_squares
        root = np.sqrt(squares)
        total += grad - (root - before) / rate * value
        return -np.sign(total) * np.maximum(np.abs(total) - sure * root, 0) * rate / (ease + root)

    size, certain = min(batch, max(64, n // 16)), min(CERTAIN, 0.5 * np.sqrt(min(y.sum(), n - y.sum())))
    for epoch in range(1, epochs + 1):
        order, sure = rng.permutation(n), certain * np.sqrt(epoch)  # an epoch repeats the rows' noise, so sums grow by epochs, roots by their root
        for s in range(0, n, size):
            own = order[s : s + size]
            many, m = counts[own], len(own)
            a = at[np.repeat(begin[own] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())]
            doc = np.repeat(np.arange(m), many)
            raw, others = bias + np.bincount(doc, w[a], m), []
            for f in range(k):
                x = v[f][a]
                sums = np.bincount(doc, x, m)
                raw += 0.5 * (sums**2 - np.bincount(doc, x * x, m))
                others.append(sums[doc] - x)
            err = share[own] * (probability(raw) - y[own])
            e = err[doc]
            w = step(w, w_sum, w_squares, np.bincount(a, e, n_rows), np.bincount(a, e * e, n_rows), sure, 1.0)
            for f in range(k):
                x = e * others[f]
                v[f] = start[f] + step(v[f] - start[f], v_sum[f], v_squares[f], np.bincount(a, x, n_rows), np.bincount(a, x * x, n_rows), sure, 0.1)
            bias_squares += (err**2).sum()
            bias -= rate * err.sum() / (1 + np.sqrt(bias_squares))
    return np.flatnonzero((w != 0) | (v != start).any(0))


def train(found: list[np.ndarray], toxic: np.ndarray, n_terms: int, k: int = 4, epochs: int = 25, batch: int = 512, rate: float = 0.1, decay: float = 2e-4, seed: int = 17):
    """bias, weights, factors of a machine fitted to documents (rows of terms) and their classes; ``k`` 0 is a linear model."""
    rng = np.random.default_rng(seed)
    y = toxic.astype(float)
    prior = (y.sum() + 1) / (len(y) + 2)
    bias, w, v = float(np.log(prior / (1 - prior))), np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, k))
    if not len(y) or y.min() == y.max() or not n_terms:
        return bias, w, np.zeros_like(v)
    share = _weighing(toxic, y)
    gb, gw, gv = 1e-6, np.full(n_terms, 1e-6), np.full((n_terms, k), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            own = order[s : s + batch]
            rows = [found[i] for i in own]
            at, doc = np.concatenate(rows), np.repeat(np.arange(len(own)), [len(r) for r in rows])
            raw = bias + np.bincount(doc, w[at], len(own))
            sums = np.zeros((len(own), k))
            for f, c in enumerate(v[at].T):
                sums[:, f] = np.bincount(doc, c, len(own))
                raw += 0.5 * (sums[:, f] ** 2 - np.bincount(doc, c * c, len(own)))
            err = share[own] * (probability(raw) - y[own]) / len(own)
            db, dw = err.sum(), np.bincount(at, err[doc], n_terms) + decay * w
            gb, gw = gb + db**2, gw + dw**2
            bias, w = bias - rate * db / np.sqrt(gb), w - rate * dw / np.sqrt(gw)
            if k:
                each = err[doc, None] * (sums[doc] - v[at])
                dv = np.stack([np.bincount(at, c, n_terms) for c in each.T], 1) + decay * v
                gv = gv + dv**2
                v = v - rate * dv / np.sqrt(gv)
    return float(bias), w, v


def fit_rows(at: np.ndarray, counts: np.ndarray, toxic: np.ndarray, k: int = 4) -> Model:
    """The model of documents: their rows one after the other, ``counts`` of them each, and their classes."""
    if not len(toxic) or toxic.min() == toxic.max():
        bias, w, v = train([], toxic, 0, k)
        return Model(bias, {}, w, v)
    used = np.flatnonzero(np.bincount(at, minlength=1 << BITS))
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    at = place[at]
    live = search(at, counts, toxic, len(used), k)
    place = np.full(len(used), -1, np.int32)
    place[live] = np.arange(len(live))
    at = place[at]
    many = np.concatenate(([0], np.cumsum(at >= 0)))  # of the rows before each place, how many are live
    ends = np.cumsum(counts)
    found, live = np.split(at[at >= 0], many[ends[:-1]]), used[live]
    bias, w, v = train(found, toxic, len(live), k)
    return Model(bias, {int(r): i for i, r in enumerate(live)}, w, v)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_terms: int = 24_000_000) -> Model:
    """docs (doc_id, text); labels (doc_id, toxic): at most ``max_rows`` labelled doc_ids are used, with all their terms.

    A doc_id is fitted once, by the text with the least hash if several rows have it. Documents are taken in the order of
    their doc_id's hash while they have up to ``max_terms`` terms together, so the driver gets at most 4 bytes of each.
    """
    chosen = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = cut(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "labels")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")  # max_rows rows of 12 bytes
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("first")).select("doc_id", "first.text", "toxic", "first.tie")
    found = cut(rows.mapInArrow(tidied(_found), "doc_id long, toxic int, tie long, found array<int>"), "labelled")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # max_rows rows at most
    taken = found.select("doc_id", F.sum(F.size("found")).over(before).alias("terms")).filter(F.col("terms") <= max_terms).select("doc_id")
    held = found.join(F.broadcast(taken), "doc_id", "left_semi").orderBy("doc_id").toArrow()
    lists = held.column("found").combine_chunks()
    at, counts = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    return fit_rows(at, counts, held.column("toxic").to_numpy())


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        find = Finder(model.terms)
        for batch in batches:
            raw = raw_scores(model, [find(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability(raw))], ["doc_id", "score"])

    return run


def held_out(id_col: str = "doc_id"):
    """Column: the row is never learnt from."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS == 0


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""
    docs = id_text(docs, id_col, text_col)
    return docs.mapInArrow(tidied(_scored(docs.sparkSession.sparkContext.broadcast(model))), "doc_id long, score double")


def _clean(shared, text_col: str, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        find = Finder(model.terms)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            keep = probability(raw_scores(model, [find(t or "") for t in texts])) < limit
            yield batch.filter(pa.array(keep))

    return run


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns; a model without terms, which can't tell documents apart, rejects none."""
    if not model.terms:
        return docs
    return docs.mapInArrow(tidied(_clean(docs.sparkSession.sparkContext.broadcast(model), text_col, limit)), docs.schema)
