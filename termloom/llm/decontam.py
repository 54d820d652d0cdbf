"""Benchmark decontamination by spaced seeds.

A mask marks some positions of a window of words; a window's hash covers only
those, so words at the others may differ. Hashes of every window of every
benchmark item and of every whole document are joined; around each hit the item
is laid on the document word by word, and the overlap counts where it is the
item's whole length, or a stretch of at least ``min_words``, with at least
``identity`` of its words equal.

No such overlap is without a hit, for the defaults: a stretch of 26 words or more has a
half of at least 13 that is as much alike, and in 13 to 25 words with at most a fifth
of them changed some mask fits at some place, whichever words changed (tests try all).
Items of fewer words have masks of their own length that leave out every choice of as
many words as may differ.

The benchmark is cut into blocks of a bounded number of words; each block's index is
broadcast (65 MB at most), and every block meets every document, in one pass. The join of
hashes is a search of a block's sorted ones; documents don't move. The driver builds one
index after the other and keeps their broadcast files, so a benchmark should stay below
some 10^8 words, whatever the number of documents.

Words that repeat give a place of a text as many hits as the item has such places; hits
that only carry on a diagonal (the windows before are a hit already) are left out, and the
rest is gone through a bounded number at a time.

Defined cases: null and empty texts have no words and never match; rows that repeat
each give their matches; of several overlaps of a document and an item the best (most
equal words, then first) is returned; empty tables give an empty result; other columns
are ignored by ``matches`` and pass through ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.words import BASE, Words, mixed, slabs, words_of

#: Fixed masks; 1: the word counts, 0: any word. Together they hit every pattern of changes that IDENTITY allows in MIN_WORDS words or more.
MASKS = ("11101111", "11010010111", "111110011", "1100100010111", "1110101001001", "1111111")
#: Words of the benchmark that one broadcast index may hold: about 65 MB of arrays.
BLOCK_WORDS = 400_000
IDENTITY = 0.8
MIN_WORDS = 13
#: Bits of a hash that the table of known ones takes, at most.
_BITS = 22
#: Hits that are held at once.
HELD_HITS = 1_000_000


def short_masks(n: int) -> list[str]:
    """Masks for a whole item of ``n`` words, under MIN_WORDS: every choice of as many words as IDENTITY lets differ is left out by one."""
    may = round((1 - IDENTITY) * 1000) * n // 1000
    parts = np.arange(n) if may < 2 else np.arange(n) * (2 * may + 1) // n
    return ["".join("0" if p in out else "1" for p in parts) for out in combinations(range(parts[-1] + 1), may)]


def _mask_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window of words under a mask."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), BASE
    with np.errstate(over="ignore"):
        for i, c in enumerate(mask):
            if c == "1":
                out += h[i : i + n] * factor
                factor *= BASE
    return mixed(out)


@dataclass
class Index:
    """A block of the benchmark: its words' hashes, and for each mask its windows.

    Windows are told by their hashes, sorted, their places, how many of them up to here
    don't carry on the window before (of equal ones those come first), a table of hashes'
    first bits, and how far a hash is shifted for it.
    """

    ids: list
    words: np.ndarray
    first: np.ndarray
    masks: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.uint64]]


def build_index(ids: list, texts: list[str | None]) -> Index:
    w = words_of(texts)
    h, sizes = w.hashes(), np.diff(w.first)
    lengths = sorted({int(n) for n in sizes if n > 0})
    masks = []
    for mask, short in (*((m, False) for m in MASKS if lengths and lengths[-1] >= MIN_WORDS), *((m, True) for n in lengths if n < MIN_WORDS for m in short_masks(n))):
        found = _mask_hashes(h, mask)
        at = np.arange(len(found))
        own = w.owner[: len(found)]
        whole = (at + len(mask) <= w.first[own + 1]) & (len(mask) == sizes[own] if short else sizes[own] >= MIN_WORDS)
        more = np.append(False, (found[1:] == found[:-1]) & (own[1:] == own[:-1]) & whole[:-1]) if len(found) else np.zeros(0, bool)
        at = at[whole]
        at = at[np.lexsort((at, more[at], found[at]))]
        bits = min(_BITS, (8 * len(at)).bit_length() + 2)
        shift = np.uint64(64 - bits)
        known = np.zeros(1 << bits, bool)
        known[(found[at] >> shift).astype(np.int64)] = True
        masks.append((mask, found[at], at, np.append(0, np.cumsum(~more[at])), known, shift))
    return Index(ids, h, w.first, masks)


def _best(same: np.ndarray, identity: float, min_words: int, whole: bool) -> tuple[int, int] | None:
    """The stretch of an overlap that counts: all of it if it is the item's length and alike, else the best stretch of at least ``min_words``."""
    if whole and same.mean() >= identity:
        return 0, len(same)
    if len(same) < max(min_words, 1):
        return None
    # Equal words count so that a stretch's sum is 0 or more where at least ``identity`` of it is equal.
    sums = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - identity, -identity))])
    # Each end's best start among those at least ``min_words`` before it.
    gain = sums[min_words:] - np.minimum.accumulate(sums[: len(sums) - min_words])
    at = int(gain.argmax())
    if gain[at] < -1e-9:
        return None
    return int(sums[: at + 1].argmin()), at + min_words


def search_texts(index: Index, texts: list[str | None], identity: float = IDENTITY, min_words: int = MIN_WORDS) -> list[tuple]:
    """``search`` over texts, a bounded number of characters at a time."""
    return [(a + m[0], *m[1:]) for a, b in slabs(texts) for m in search(index, words_of(texts[a:b]), identity, min_words)]


def search(index: Index, w: Words, identity: float = IDENTITY, min_words: int = MIN_WORDS) -> list[tuple]:
    """Matches of a batch: text, item, first word in the text, first word in the item, words, equal words."""
    h = w.hashes()
    span = len(h) + len(index.words) + 1
    hits = np.zeros(0, np.int64)  # a text, item and diagonal as one number
    for mask, hashes, places, begun, known, shift in index.masks:
        found = _mask_hashes(h, mask)
        if not len(found) or not len(hashes):
            continue
        may = np.flatnonzero(known[(found >> shift).astype(np.int64)])
        lo, hi = np.searchsorted(hashes, found[may]), np.searchsorted(hashes, found[may], "right")
        inside = (hi > lo) & (may + len(mask) <= w.first[w.owner[may] + 1])
        may, lo, hi = may[inside], lo[inside], hi[inside]
        # A window equal to the one before it meets only those that don't carry on theirs: the others' diagonals are hit already.
        more = (may > w.first[w.owner[may]]) & (found[may] == found[np.maximum(may - 1, 0)])
        n = np.where(more, begun[hi] - begun[lo], hi - lo)
        upto = np.cumsum(n)
        first = 0
        while first < len(may):
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + HELD_HITS, "right")))
            m = n[first:last]
            at = np.repeat(may[first:last], m)
            j = places[np.repeat(lo[first:last], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
            told = (w.owner[at] * len(index.ids) + np.searchsorted(index.first, j, "right") - 1) * span + (at - j) + len(index.words)
            hits = np.union1d(hits, told)
            first = last
    best: dict[tuple[int, int], tuple] = {}
    for told in hits.tolist():
        pair, shift = divmod(told, span)
        (text, item), shift = divmod(pair, len(index.ids)), shift - len(index.words)
        d0, d1, i0, i1 = int(w.first[text]), int(w.first[text + 1]), int(index.first[item]), int(index.first[item + 1])
        lo, hi = max(i0, d0 - shift), min(i1, d1 - shift)
        same = h[lo + shift : hi + shift] == index.words[lo:hi]
        got = _best(same, identity, min_words, (lo, hi) == (i0, i1))
        if got:
            a, b = got
            row = (text, item, lo + shift - d0 + a, lo - i0 + a, b - a, int(same[a:b].sum()))
            old = best.get((text, item))
            if old is None or (-row[5], row[2]) < (-old[5], old[2]):
                best[text, item] = row
    return list(best.values())


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """The blocks of the benchmark, one after the other; sizes are summed by Spark before anything is collected."""
    n_chars = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    blocks = max(1, -(-int(n_chars) // (2 * block_words)))  # a word and its gap take two characters at least
    keyed = benchmark.select(id_col, text_col).withColumn("_block", F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)))
    for b in range(blocks):
        rows = sorted(keyed.where(F.col("_block") == b).select(id_col, text_col).collect(), key=lambda r: (str(r[0]), r[1] or ""))
        yield build_index([r[0] for r in rows], [r[1] for r in rows])


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", identity: float = IDENTITY, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document and benchmark item that it holds: the overlap's places, words and equal words."""
    spark, out = docs.sparkSession, None
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    for index in indexes(benchmark, item_col):
        held = spark.sparkContext.broadcast(index)

        def rows(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                got = search_texts(held.value, batch.column(1).to_pylist(), identity, min_words)
                if got:
                    text, item, *rest = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), pa.array([held.value.ids[i] for i in item]), *(pa.array(x, pa.int32()) for x in rest)], [id_col, item_col, "doc_from", "item_from", "n_words", "n_equal"])

        part = docs.select(id_col, text_col).mapInArrow(rows, f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, doc_from int, item_from int, n_words int, n_equal int")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    spark = docs.sparkSession
    for index in indexes(benchmark):
        held = spark.sparkContext.broadcast(index)

        def rows(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                keep = np.ones(len(texts), bool)
                keep[[m[0] for m in search_texts(held.value, texts)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs


def op3_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return matches(docs, benchmark).withColumn("identity", F.col("n_equal") / F.col("n_words"))
