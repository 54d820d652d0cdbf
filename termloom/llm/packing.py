"""Best-fit packing of documents into sequences of a fixed capacity, in bulk-synchronous rounds.

Pieces and gaps (the free ends of open sequences) are range-sorted by size and
kept as runs: all pieces of one length are alike but for their rank, so a run is
(length, first rank, count), and a gap run is (size, first sequence, count). There
are at most ``capacity`` lengths, so the state of a round is bounded whatever the
number of documents. A round

1. finds for each piece run the size range that holds its successor, the smallest
   gap that it fits into (a sweep over the ranges);
2. in every range at once, sweeps pieces from long to short and puts each into the
   smallest gap that holds it; where several want a gap, rank decides;
3. returns the shortened gaps and the pieces left over to the next round;
4. opens for pieces that no gap can hold as many sequences as they need at least.

Rounds end when no piece is left. Each piece's place follows from its rank and
the run that was placed. Ranks come from a distributed range sort.

Defined cases: a null text counts as empty; an empty text still has its end id, so
a piece of length 1; rows that repeat are packed each; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ranked, written
from termloom.llm.tokens import WordPieces

#: Size ranges that a round sweeps at once.
RANGES = 8
STATE = "kind string, size int, first long, n long, bin long, at int, per int"


def sweep(docs: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], capacity: int) -> tuple[list, list, list]:
    """Best fit of one range: docs (length, first rank, n), gaps (size, first sequence, n).

    Returns placed (length, first rank, n, first sequence, offset, pieces per sequence), docs left, gaps left.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for size, first, n in sorted(gaps, reverse=True):
        runs[size].append((first, n))
    sizes = sorted(runs)

    def give(size: int, first: int, n: int) -> None:
        if size:
            if not runs[size]:
                insort(sizes, size)
            runs[size].append((first, n))

    placed, left = [], []
    for length, rank, n in sorted(docs, key=lambda d: (-d[0], d[1])):
        while n:
            i = bisect_left(sizes, length)
            if i == len(sizes):
                left.append((length, rank, n))
                break
            size = sizes[i]
            first, m = runs[size].pop()
            if not runs[size]:
                del sizes[i]
            per = min(size // length, n)
            bins = min(m, n // per)
            placed.append((length, rank, bins * per, first, capacity - size, per))
            if m > bins:
                give(size, first + bins, m - bins)
            give(size - per * length, first, bins)
            rank, n = rank + bins * per, n - bins * per
    return placed, left, [(size, first, n) for size, all_ in runs.items() for first, n in all_]


def bins_needed(docs: list[tuple[int, int]], capacity: int) -> int:
    """Sequences that pieces (length, n) need at least: one for each long one, and what the short ones overflow."""
    long_ = sum(n for size, n in docs if 2 * size > capacity)
    room = sum(n * (capacity - size) for size, n in docs if 2 * size > capacity)
    short = sum(n * size for size, n in docs if 2 * size <= capacity)
    return long_ + max(0, -(-(short - room) // capacity))


def _swept(capacity: int):  # noqa: ANN202
    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: list(zip(*(g[c].tolist() for c in ("size", "first", "n")), strict=True)) for k, g in pdf.groupby("kind")}
        placed, left, gaps = sweep(kinds.get("doc", []), kinds.get("gap", []), capacity)
        out = [("placed", *p) for p in placed] + [("doc", *d, 0, 0, 0) for d in left] + [("gap", *g, 0, 0, 0) for g in gaps]
        return pd.DataFrame(out, columns=["kind", "size", "first", "n", "bin", "at", "per"])

    return rows


def place_runs(lengths: DataFrame, capacity: int, ranges: int = RANGES) -> DataFrame:
    """Rounds over the run table of ``lengths`` (size, n): rows of placed runs.

    Result: size int, first long (rank), n long, bin long, at int, per int.
    """
    spark = lengths.sparkSession
    width = -(-capacity // ranges)
    own = ((F.col("size") - 1) / width).cast("int")
    state = written(
        lengths.select(F.lit("doc").alias("kind"), F.col("size").cast("int").alias("size"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long").alias("n"), F.lit(0).cast("long").alias("bin"), F.lit(0).alias("at"), F.lit(0).alias("per")),
        "pack-runs",
    )
    done, opened = [state.where("false")], 0
    while True:
        # At most 2 x capacity rows whatever the input: the counts by size.
        sums = state.where(F.col("kind") != "placed").groupBy("kind", "size").agg(F.sum("n").alias("n")).collect()
        docs = [(r["size"], r["n"]) for r in sums if r["kind"] == "doc"]
        if not docs:
            break
        top = [0] * ranges
        for r in sums:
            if r["kind"] == "gap":
                top[(r["size"] - 1) // width] = max(top[(r["size"] - 1) // width], r["size"])
        largest = max(top)
        lone = bins_needed([d for d in docs if d[0] > largest], capacity)
        fresh = spark.createDataFrame([("gap", capacity, opened, lone, 0, 0, 0)] if lone else [], STATE)
        opened += lone
        if lone:
            top[(capacity - 1) // width] = capacity
        # The successor's range: the first, from the piece's own on, whose largest gap holds it.
        target = F.lit(None).cast("int")
        for k in reversed(range(ranges)):
            target = F.when((own <= k) & (F.col("size") <= top[k]), k).otherwise(target)
        goes = F.when(F.col("kind") == "gap", own).otherwise(target)
        live = state.where(F.col("kind") != "placed").unionByName(fresh).withColumn("range", goes)
        state = written(
            live.repartition(ranges, "range").groupBy("range").applyInPandas(_swept(capacity), STATE),
            "pack-round",
        )
        done.append(state.where(F.col("kind") == "placed"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("size", "first", "n", "bin", "at", "per")


def pack(pieces: DataFrame, capacity: int, ranges: int = RANGES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to materialised ``pieces`` (…, length) with lengths of 1 to ``capacity``.

    The table of placed runs is bounded by lengths and rounds, not by rows, so it is broadcast.
    """
    order = [c for c in pieces.columns if c != "length"]
    lined = ranked(pieces, ["length"], order, "_rank")
    lengths = lined.groupBy("length").agg(F.count(F.lit(1)).alias("n")).select(F.col("length").cast("int").alias("size"), "n")
    runs = written(place_runs(lengths, capacity, ranges), "pack-placed")
    place = F.col("_rank") - F.col("first")
    return (
        lined.join(F.broadcast(runs), (F.col("length") == F.col("size")) & (place >= 0) & (place < F.col("n")))
        .withColumn("sequence_id", F.col("bin") + F.expr("(_rank - first) div per"))
        .withColumn("offset", (F.col("at") + F.pmod(place, F.col("per")) * F.col("length")).cast("long"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text: its ids, then ``end_id``; longer ones cut at multiples of ``capacity``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordPieces.of(tokenizer), struct.pack("<I", end_id)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            whose, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(words.encode_bytes(texts)):
                ids += end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    whose.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(whose, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                [id_col, "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).mapInArrow(rows, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return pack(written(tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pack-pieces"), capacity)


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: sequences, tokens and the share of the sequences' places that hold tokens."""
    return packed.agg(F.countDistinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens")).withColumn("fill", F.col("tokens") / (F.col("sequences") * capacity))


def ids_of(raw: bytes) -> np.ndarray:
    """The ids in a piece's bytes."""
    return np.frombuffer(raw, "<u4")
