"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is cut into segments of ``SEGMENT`` words. A segment's vector is the mean
of the embeddings of its words' character n-grams (3 to 5 bytes with the word's
borders, hashed into buckets), so misspellings share most of a word's vectors; a
softmax over two classes follows. A text's score is its worst segment's
probability, so one insult in a long text counts. Embeddings and softmax are
trained together by Adagrad: first every segment has its text's label, then each
text is represented by its worst segment.

Both classes' gradients differ by sign only, so an embedding's gradient is a number
times the difference of the softmax's columns; steps use that and stay exact.

Labelled rows are used up to ``MAX_LABELS`` of each class, chosen by hash of the id.
Inference reads every whole text once, with the model (4 MB) broadcast.

The n-grams of a long text are looked up some segments at a time; that changes no score.

Defined cases: a null or empty text has no segments and the bias's probability;
equal texts have equal scores; labels of unknown rows and null labels are ignored;
without labels of both classes the score is 0; an empty table gives an empty result;
other columns never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import free_name
from termloom.llm.words import Words, slabs, words_of

SEGMENT = 12
GRAMS = (3, 4, 5)
BUCKET_BITS = 17
WIDTH = 8
#: Labelled rows of each class that training takes at most.
MAX_LABELS = 1500
#: Words of one text whose n-grams are looked up at once; a multiple of SEGMENT.
HELD_WORDS = 6000 * SEGMENT
THRESHOLD = 0.7
_SPREAD = np.uint64(0xFF51AFD7ED558CCD)


@dataclass
class Model:
    """``grams``: the softmax's difference along each bucket's embedding; ``bias``; ``embeddings`` and ``softmax`` as trained."""

    grams: np.ndarray
    bias: float
    embeddings: np.ndarray
    softmax: np.ndarray


@dataclass
class Bags:
    """Bucket of every n-gram, the segment that each begins, and each segment's text."""

    buckets: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray


def bags_of(texts: list[str | None]) -> Bags:
    """The n-gram buckets of texts' segments."""
    w = words_of(texts)
    return _bags(w, 0, len(w.starts))


def _bags(w: Words, lo: int, hi: int) -> Bags:
    """The same of the words ``lo`` to ``hi``, whose first begins a segment."""
    if lo >= hi:
        return Bags(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    base = w.starts[lo] - 1
    starts, ends = w.starts[lo:hi] - base, w.ends[lo:hi] - base
    b = w.buffer[base : w.ends[hi - 1] + 1].astype(np.uint64)
    # Bytes between words are all alike as borders.
    border = np.ones(len(b), bool)
    size = ends - starts
    within = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    border[within] = False
    b[border] = 32
    found, at = [], []
    # From the border before a word on, up to the border after it; a word of one letter has one gram of three.
    spans = np.repeat(starts - 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())
    last = np.repeat(ends + 1, size)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            p = spans[spans + n <= last]
            h = np.full(len(p), n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + b[p + k]
            found.append(((h * _SPREAD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            at.append(p)
    buckets, at = np.concatenate(found), np.concatenate(at)
    owner = w.owner[lo:hi]
    new = np.flatnonzero((np.arange(lo, hi) - w.first[owner]) % SEGMENT == 0)
    segment = np.searchsorted(starts[new] - 1, at, "right") - 1
    order = np.argsort(segment, kind="stable")
    sizes = np.bincount(segment, minlength=len(new))
    return Bags(buckets[order], np.cumsum(sizes) - sizes, sizes, owner[new])


def segment_logits(bags: Bags, grams: np.ndarray, bias: float) -> np.ndarray:
    if not len(bags.starts):
        return np.zeros(0)
    return np.add.reduceat(grams[bags.buckets].astype(np.float64), bags.starts) / bags.sizes + bias


def _along(e: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Each embedding's product with the softmax's difference; small, so it isn't worth BLAS's threads."""
    return np.einsum("ij,j->i", e, d.astype(np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[str | None], labels: list[int], seed: int = 7, batch: int = 32, steps: int = 500, refine: int = 900) -> Model:
    """Joint training on labelled texts; deterministic for equal input."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, float)
    e = rng.normal(0, 0.1, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    u = rng.normal(0, 0.5, (WIDTH, 2))
    bias = np.zeros(2)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), -np.inf, e, u)
    seen_e, seen_u, seen_b = np.full(1 << BUCKET_BITS, 1e-6), np.full(WIDTH, 1e-6), 1e-6
    pos, neg = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for step in range(steps + refine):
        # Half of a batch from each class.
        take = np.concatenate([rng.choice(pos, batch // 2), rng.choice(neg, batch // 2)])
        bags = bags_of([texts[i] for i in take])
        if not len(bags.starts):
            continue
        d = u[:, 1] - u[:, 0]
        logit = segment_logits(bags, _along(e, d), bias[1] - bias[0])
        miss = _sigmoid(logit) - y[take][bags.owner]
        if step >= steps:
            # Only the worst segment of each text.
            order = np.lexsort((logit, bags.owner))
            worst = order[np.append(np.flatnonzero(np.diff(bags.owner[order])), len(order) - 1)]
            mask = np.zeros(len(miss))
            mask[worst] = 1
            miss = miss * mask / len(worst)
        else:
            # Each text weighs alike.
            miss = miss / (np.bincount(bags.owner)[bags.owner] * len(take))
        g = np.bincount(bags.buckets, np.repeat(miss / bags.sizes, bags.sizes), 1 << BUCKET_BITS)
        du, db = np.einsum("i,ij->j", g, e), miss.sum()
        seen_e += g * g * (d @ d)
        seen_u += du * du
        seen_b += db * db
        rate = 0.5
        hit = np.flatnonzero(g)
        e[hit] -= (rate * g[hit] / np.sqrt(seen_e[hit]))[:, None].astype(np.float32) * d.astype(np.float32)
        change = 0.05 * du / np.sqrt(seen_u)
        u[:, 1] -= change / 2
        u[:, 0] += change / 2
        bias += np.array([0.5, -0.5]) * 0.1 * db / np.sqrt(seen_b)
    d = u[:, 1] - u[:, 0]
    return Model(_along(e, d), float(bias[1] - bias[0]), e, u)


def score_texts(texts: list[str | None], grams: np.ndarray, bias: float) -> np.ndarray:
    """Each text's worst segment's probability; of a text without words, the bias's."""
    top = np.full(len(texts), -np.inf)
    for a, b in slabs(texts):
        w = words_of(texts[a:b])
        step = HELD_WORDS if b - a == 1 else max(len(w.starts), 1)
        for lo in range(0, len(w.starts), step):
            bags = _bags(w, lo, min(lo + step, len(w.starts)))
            np.maximum.at(top, a + bags.owner, segment_logits(bags, grams, bias))
    top[np.isneginf(top)] = bias
    return np.where(np.isneginf(top), 0.0, _sigmoid(top))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labels: int = MAX_LABELS) -> Model:
    """Trains on at most ``max_labels`` labelled rows of each class (by hash of the id), but no held-out ones.

    Their ids are chosen from the labels alone, so the texts are found by a join with a table of bounded size.
    """
    known = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).distinct()
    order = [F.xxhash64("_id"), F.col("_id"), F.col("_y")]
    chosen = known.where("_y = 1").orderBy(*order).limit(max_labels).unionByName(known.where("_y = 0").orderBy(*order).limit(max_labels))
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).dropDuplicates([id_col, "_y"]).select("_id", text_col, "_y").collect()
    rows = sorted(rows, key=lambda r: (r["_id"], r["_y"]))
    return train([r[text_col] for r in rows], [r["_y"] for r in rows])


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast((model.grams, model.bias))

    @F.pandas_udf("double")
    def of(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(score_texts(texts.tolist(), *held.value))

    return docs.withColumn(name, of(F.col(text_col)))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that the model rejects."""
    name = free_name(docs.columns, "tox_score")
    return scored(docs, model, name=name).where(F.col(name) < threshold).drop(name)


def op10_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A score of every document, as op10's contract has it."""
    model = fit(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast((model.grams, model.bias))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score_texts(batch.column(1).to_pylist(), *held.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
