"""Near-duplicate documents by order MinHash, verified by banded alignment.

A text's units are its runs of five words, each labelled by its occurrence number.
For each of 32 hash functions the two units of least hash are kept in text order
(order MinHash); with the function's number they are a key. Texts that share a key
are candidates. A candidate pair is verified by the longest common subsequence of
the texts' words, in a band wide enough for any pair that can reach the threshold;
the similarity is the common words over all words, and pairs of 0.8 or more are
links, if half of their distinct words are in common too (so a pair of words said
hundreds of times does not make texts alike). Classes are the connected components of
links; equal texts are one text from the start. A pair whose runs of five words, in
order, reach 0.8 reaches it in words.

Pairs within a class are not listed. First one text leads each key of the first twelve
functions and meets those of the key's other texts that are likely links, which unites
groups of copies at the cost of twelve rows a text. Likely are those whose MinHash bits
agree: 128 bits of labelled words that differ in at most 28 places, and 256 bits of
distinct words that differ in at most 85. Then, in all keys that still hold several
classes, every two texts of different classes meet, in the first such key that they share
and in no other, whatever those bits say; so no two texts that share a key stay apart
unless they were compared. In each key one class, most often the largest, is the main one,
and only texts of the others begin a comparison.

Pairs that cannot be links go before texts are read, by bounds that no link breaks: the
shorter text has 0.8 of the longer one's words; the parities of word counts, in 1024 bins,
differ in no more places than a link's texts have words that aren't in common, a ninth of
all words at most; and those of distinct words, in 512 bins, in no more than a third of
both texts' distinct words.

Texts of keys of more than ``DEALT`` texts meet by their rare words instead: a link's texts
have 0.8 of either's labelled words in common, so in any one order of all words they share
one of the first fifth (and one more) of each. Rare words come first, so few texts meet.
Keys and classes that hold a large share of all rows are few, and are joined without a
shuffle.

Defined cases: null and empty texts, and texts without a word, are classes of equal texts only; a
text of one to four words is one unit; rows that repeat are in one class; a class's id
is its least doc_id (null only if all are null); an empty table gives an empty result;
other columns are ignored by ``classes`` and pass through ``keep_one`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import free_name, spread_join, written
from termloom.llm.decontam import _mask_hashes
from termloom.llm.words import BASE, mixed, slabs, words_of

UNIT_WORDS = 5
SIMILARITY = 0.8
FUNCTIONS = 32
KEPT = 2
#: Functions whose keys unite groups of copies before all keys are looked at.
FIRST_FUNCTIONS = 12
#: A text has fewer units than 2**32: Spark's strings end at 2**31 bytes.
_PLACE_BITS = np.uint64(32)
#: Least share of common ones among a pair's distinct words.
DISTINCT = 0.5
#: Bits of labelled and of distinct words, and the most places that they may differ in.
BITS = (128, 256)
BITS_APART = (28, 85)
#: Rounds of the word hash that fill the bits of short texts.
BIT_ROUNDS = 64
#: Bins of a text's words, and of its distinct words, whose counts' parities are kept.
BINS = (1024, 512)
#: The texts of keys of more texts than this meet by their rare words.
DEALT = 4096
#: Bins in which labelled words are counted to tell rare ones.
COUNT_BITS = 16
#: Parts that a leader's comparisons are spread over.
SALTS = 32
#: Rows of the band that share one table of word places.
BAND_ROWS = 16_384

_BITS = [f"bits{k}" for k in range(sum(BITS) // 64)]
_PARITIES = [f"parity{k}" for k in range(sum(BINS) // 64)]
#: ``u``: distinct words.
_SKETCH = [*_BITS, *_PARITIES, "u"]


def _runs(h: np.ndarray, word_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word runs of texts from their words' hashes, and each text's first run."""
    n = np.diff(word_first)
    runs = _mask_hashes(h, "1" * UNIT_WORDS)
    full = n >= UNIT_WORDS
    counts = np.where(full, n - UNIT_WORDS + 1, np.minimum(n, 1))
    first = np.append(0, np.cumsum(counts))
    out = np.zeros(first[-1], np.uint64)
    into = np.repeat(full, counts)
    at = np.repeat(word_first[:-1] - first[:-1], counts) + np.arange(first[-1])
    out[into] = runs[at[into]]
    for i in np.flatnonzero((n > 0) & ~full):
        out[first[i]] = _mask_hashes(h[word_first[i] : word_first[i + 1]], "1" * int(n[i]))[0]
    return out, first


def labelled(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units mixed with their occurrence number in their text, and which are first occurrences."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        own = units ^ mixed(owner.astype(np.uint64) * BASE + np.uint64(1))
        order = np.argsort(own, kind="stable")
        same = np.append(False, own[order][1:] == own[order][:-1])
        if not same.any():
            return units, ~same
        place = np.arange(len(own))
        nth = place - np.maximum.accumulate(np.where(same, 0, place))
        out = units.copy()
        again = order[same]
        out[again] = mixed(units[again] + nth[same].astype(np.uint64) * BASE)
    once = np.ones(len(units), bool)
    once[again] = False
    return out, once


def word_bits(marked: np.ndarray, owner: np.ndarray, texts: int, bits: int) -> np.ndarray:
    """So many bits (texts x 64 bits of each) of a MinHash of words (hashes), each of the text ``owner``.

    A word's hash names one of the bins, one for a bit; a bin's value is the least hash in it, of the
    first round that puts a word there, so two texts' values agree as often as their words do.
    """
    value = np.zeros(texts * bits, np.uint64)
    empty = np.ones(texts * bits, bool)
    shift = np.uint64(64 - bits.bit_length() + 1)
    for r in range(BIT_ROUNDS):
        open_ = empty.reshape(texts, bits).any(axis=1)
        at = np.flatnonzero(open_[owner])
        if not len(at):
            break
        with np.errstate(over="ignore"):
            x = mixed(marked[at] + np.uint64(r + 1) * BASE)
        cell = owner[at] * bits + (x >> shift).astype(np.int64)
        new = empty[cell]
        cell, x = cell[new], x[new]
        order = np.argsort(x, kind="stable")[::-1]
        # Of several values the last one assigned stays: the least.
        value[cell[order]] = x[order]
        empty[cell] = False
    bit = ((value >> np.uint64(5)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bit.reshape(texts, bits), axis=1).view(np.uint64).reshape(texts, bits // 64)


def parities(h: np.ndarray, owner: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """Whether each text's words (hashes) in each of so many bins are odd in number (texts x 64 bins of each).

    A word that two texts don't have in common changes one bin, so their parities differ in no more places than they have such words.
    """
    at = owner * bins + (h >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=texts * bins) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, bins), axis=1).view(np.uint64).reshape(texts, bins // 64)


def sketches(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (texts x FUNCTIONS), word counts, and word bits, parities and distinct words (texts x 31: bits of labelled and of distinct words, parities of both, number); keys of texts without words mean nothing."""
    w = words_of(texts)
    h, words = w.hashes(), np.diff(w.first)
    units, first = _runs(h, w.first)
    n = np.diff(first)
    keys = np.zeros((len(texts), FUNCTIONS), np.uint64)
    has = np.flatnonzero(n > 0)
    if not len(has):
        return keys, words, np.zeros((len(texts), len(_SKETCH)), np.uint64)
    marked, _ = labelled(units, first)
    starts, place = first[has], np.arange(len(units), dtype=np.uint64) - np.repeat(first[:-1], n).astype(np.uint64)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    most, owners = np.uint64(0xFFFFFFFFFFFFFFFF), np.arange(len(has))
    spread = marked ^ (marked >> np.uint64(31))
    with np.errstate(over="ignore"):
        for e in range(FUNCTIONS):
            factor = mixed(np.array([e + 1], np.uint64) * BASE)[0] | np.uint64(1)
            value = ((spread * factor) & ~low) | place
            least = np.empty((KEPT, len(has)), np.uint64)
            for k in range(KEPT):
                least[k] = np.minimum.reduceat(value, starts)
                there = least[k] != most
                value[(starts + (least[k] & low).astype(np.int64))[there]] = most
            # In text order; missing ones (short texts) come last and count as 0.
            at = np.where(least == most, low, least & low)
            order = np.argsort(at, axis=0, kind="stable")
            code = np.full(len(has), e + 1, np.uint64)
            for k in range(KEPT):
                picked = least[order[k], owners]
                unit = np.where(picked == most, np.uint64(0), marked[starts + np.minimum((picked & low).astype(np.int64), n[has] - 1)])
                code = mixed(code * BASE + unit)
            keys[has, e] = code
    each, once = labelled(h, w.first)
    bits = [word_bits(each, w.owner, len(texts), BITS[0]), word_bits(h[once], w.owner[once], len(texts), BITS[1])]
    odd = [parities(h, w.owner, len(texts), BINS[0]), parities(h[once], w.owner[once], len(texts), BINS[1])]
    return keys, words, np.hstack([*bits, *odd, np.bincount(w.owner[once], minlength=len(texts)).astype(np.uint64)[:, None]])


def _places(words: np.ndarray, wanted: set[int]) -> dict[int, int]:
    """For each wanted word a number whose bits are the word's places in ``words``."""
    found: dict[int, int] = {}
    if len(words) <= 4096:
        for j, w in enumerate(words.tolist()):
            if w in wanted:
                found[w] = found.get(w, 0) | (1 << j)
        return found
    order = np.argsort(words, kind="stable")
    sorted_ = words[order]
    cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    for at in np.split(order, cuts):
        w = int(words[at[0]])
        if w in wanted:
            bits = np.zeros(len(words), np.uint8)
            bits[at] = 1
            found[w] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return found


def _common(a: np.ndarray, b: np.ndarray, reach: int) -> int:
    """Longest common subsequence of two sequences, of pairs within ``reach`` of the diagonal at least.

    A bit per place of ``b``, 0 where the row's count goes up, is moved on row by row by
    one addition (Crochemore et al., 2001); only the band's places are held and touched.
    """
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    lead = int(differ[0]) if len(differ) else m
    a, b, m = a[lead:], b[lead:], m - lead
    differ = np.flatnonzero(a[len(a) - m :][::-1] != b[len(b) - m :][::-1])
    tail = int(differ[0]) if len(differ) else m
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    total = lead + tail
    if not len(a) or not len(b):
        return total
    rows = max(256, min(reach, BAND_ROWS))
    v, lo, hi = 0, 0, 0  # bits of the places lo to hi
    for r in range(0, len(a), rows):
        new_lo, new_hi = min(max(0, r - reach), len(b)), min(len(b), r + rows + reach)
        drop = min(new_lo, hi) - lo
        if drop > 0:
            total += drop - (v & ((1 << drop) - 1)).bit_count()
            v >>= drop
        lo = new_lo
        if new_lo >= len(b):
            hi = lo
            break
        held = max(hi - lo, 0)
        v |= ((1 << (new_hi - lo - held)) - 1) << held
        hi = new_hi
        full = (1 << (hi - lo)) - 1
        part = a[r : r + rows].tolist()
        places = _places(b[lo:hi], set(part))
        find = places.get
        for w in part:
            at = find(w, 0)
            if at:
                met = v & at
                v = ((v + met) | (v ^ met)) & full
    return total + (hi - lo) - v.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common words in order over all words; 0 where it cannot reach ``least``, or too few distinct words are in common."""
    na, nb = len(a), len(b)
    if not na or not nb or min(na, nb) < least * max(na, nb):
        return 0.0
    need = int(np.ceil(least / (1 + least) * (na + nb) - 1e-9))
    # No alignment has more in common than the multisets.
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if np.minimum(ca[i], cb[j]).sum() < need or len(i) < DISTINCT * (len(ua) + len(ub) - len(i)):
        return 0.0
    got = _common(a, b, max(na, nb) - need)
    s = got / (na + nb - got)
    return s if s >= least else 0.0


def text_digest(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def _sketched(texts: DataFrame) -> DataFrame:
    """digest, n words, keys, word bits, parities and distinct words of each row of ``texts`` (digest, body)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in slabs(bodies, 200_000):
                keys, n, bits = sketches(bodies[a:b])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * FUNCTIONS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), flat, *(pa.array(np.ascontiguousarray(bits[:, k]).view(np.int64)) for k in range(len(_SKETCH)))], ["digest", "n", "keys", *_SKETCH])

    return texts.mapInArrow(rows, "digest binary, n long, keys array<long>, " + ", ".join(f"{x} long" for x in _SKETCH))


def _with_words(texts: DataFrame) -> DataFrame:
    """digest and the words, as unsigned 32-bit numbers, of each row of ``texts`` (digest, body)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in slabs(bodies):
                w = words_of(bodies[a:b])
                small = (w.hashes() >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([small[x:y].tobytes() for x, y in zip(w.first[:-1], w.first[1:], strict=True)], pa.binary())], ["digest", "words"])

    return texts.mapInArrow(rows, "digest binary, words binary")


def _links(pairs: DataFrame, pool: DataFrame, least: float) -> DataFrame:
    """a, b, similarity of the pairs (a, b) whose texts' similarity is ``least`` or more.

    A leader ``a`` and the texts it meets come to a task as one run of rows, the leader's
    words first and once; the texts of a leader are spread over SALTS runs.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None
        for batch in batches:
            met, words = batch.column(2).to_pylist(), batch.column(3)
            good, told = [], []
            for i, b in enumerate(met):
                mine = np.frombuffer(words[i].as_py(), "<u4")
                if b is None:
                    lead = mine
                    continue
                s = similarity(lead, mine, least)
                if s:
                    good.append(i)
                    told.append(s)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(told, pa.float64())], ["a", "b", "similarity"])

    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    members = salted.join(pool, F.col("b") == F.col("digest")).select("a", "salt", "b", "words")
    leads = salted.select("a", "salt").distinct().join(pool, F.col("a") == F.col("digest")).select("a", "salt", F.lit(None).cast("binary").alias("b"), "words")
    runs = leads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return runs.mapInArrow(rows, "a binary, b binary, similarity double")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label (the component's least node) of every node of ``links``, by alternating large and small stars."""
    edges = written(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-links")
    told = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    now = told(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "cc-links")
        seen, now = now, told(edges)
        if now == seen:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))


def _apart(bits: list[str]) -> Column:
    """Places in which the bits of a text and of its leader (as ``_as_leader`` names them) differ."""
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"a_{x}"))) for x in bits), F.lit(0))


def _may_link(least: float) -> Column:
    """The filter of a pair, a leader and a text: true of every link of two classes."""
    words_ = BINS[0] // 64
    few = (_apart(_PARITIES[:words_]) <= (1 - least) / (1 + least) * (F.col("n") + F.col("na")) + 1e-6) & (_apart(_PARITIES[words_:]) <= (1 - DISTINCT) / (1 + DISTINCT) * (F.col("u") + F.col("a_u")) + 1e-6)
    return (F.col("la") != F.col("label")) & (F.least("n", "na") >= least * F.greatest("n", "na")) & few


def _likely(least: float) -> Column:
    """A filter of pairs that are compared first; others meet again in ``_cross``."""
    labelled_ = BITS[0] // 64
    return (F.least("n", "na") >= least * F.greatest("n", "na")) & (_apart(_BITS[:labelled_]) <= BITS_APART[0]) & (_apart(_BITS[labelled_:]) <= BITS_APART[1])


def _as_leader(x: str, bits: list[str]) -> list[Column]:
    return [F.col(f"{x}.digest").alias("a"), F.col(f"{x}.n").alias("na"), *(F.col(f"{x}.{y}").alias(f"a_{y}") for y in bits)]


def _stars(rows: DataFrame, sketched: DataFrame, n_rows: int, least: float) -> DataFrame:
    """a < b: each key's least text with the key's other texts that are likely links, of rows (key, digest)."""
    groups = rows.groupBy("key").agg(F.min("digest").alias("a"), F.max("digest").alias("hi"), F.count(F.lit(1)).alias("size")).where("a != hi").select("key", "size", "a")
    met = spread_join(rows, written(groups, "near-leaders"), "key", "size", n_rows).where("a != digest").select("a", "digest").distinct()
    lead = sketched.select(F.struct("digest", "n", *_BITS).alias("x")).select(*_as_leader("x", _BITS))
    return met.join(lead, "a").join(sketched.select("digest", "n", *_BITS), "digest").where(_likely(least)).select("a", F.col("digest").alias("b"))


def rare_first(marked: np.ndarray, first: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's labelled words (hashes) those that a link must share one of, and each text's first of them.

    Words are in order of their bins' counts, then of their hashes. A link shares ``least`` of
    either text's n words, so the first one shared is among the first n - ``least`` n + 1 of both.
    """
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((marked, counts[marked >> np.uint64(64 - COUNT_BITS)], owner))
    taken = np.where(n > 0, n - np.ceil(least * n - 1e-9).astype(np.int64) + 1, 0)
    kept = np.arange(len(marked)) - np.repeat(first[:-1], n) < np.repeat(taken, n)
    return marked[order][kept], np.append(0, np.cumsum(taken))


def _rare_words(texts: DataFrame, least: float) -> DataFrame:
    """digest and the rare words (``rare_first``) of each row of ``texts`` (digest, body)."""

    def labelled_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in slabs(bodies):
                w = words_of(bodies[a:b])
                yield batch.column(0).slice(a, b - a), labelled(w.hashes(), w.first)[0], w.first

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << COUNT_BITS, np.int64)
        for _, marked, _ in labelled_words(batches):
            held += np.bincount(marked >> np.uint64(64 - COUNT_BITS), minlength=len(held))
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(held[there])], ["bin", "n"])

    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for r in texts.mapInArrow(counted, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[r["bin"]] = r["n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digests, marked, first in labelled_words(batches):
            rare, at = rare_first(marked, first, counts, least)
            yield pa.RecordBatch.from_arrays([digests, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(rare.view(np.int64)))], ["digest", "keys"])

    return texts.mapInArrow(rows, "digest binary, keys array<long>")


def _in_open_keys(every: DataFrame, n_rows: int) -> DataFrame:
    """Rows (key, digest, label) of the keys that hold several classes, with the key's size and whether the class isn't the main one (minor)."""
    mark = F.xxhash64("label")
    open_ = every.groupBy("key").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi"), F.count(F.lit(1)).alias("size"), F.min_by("label", "digest").alias("main")).where("lo != hi")
    rows = spread_join(every, written(open_.select("key", "size", "main"), "near-open"), "key", "size", n_rows)
    return rows.select("digest", "key", "size", (F.col("label") != F.col("main")).alias("minor"))


def _cross(named: DataFrame, bodies: Callable[[DataFrame], DataFrame], least: float, n_rows: int) -> DataFrame:
    """a < b: the texts of ``named`` (digest, n, label, keys, parities, u) that share a key, have different labels and may be links, each pair once.

    ``bodies`` gives the texts (digest, body) of digests.
    """
    rows = written(_in_open_keys(named.select(F.explode("keys").alias("key"), "digest", "label"), n_rows), "near-in-keys")
    large = rows.where(F.col("size") > DEALT).select("digest").distinct()
    rows = rows.where(F.col("size") <= DEALT)
    if not large.isEmpty():
        rare = written(_rare_words(bodies(large), least).dropDuplicates(["digest"]), "near-rare")
        every = rare.select(F.explode("keys").alias("key"), "digest").join(named.select("digest", "label"), "digest")
        rows = rows.unionByName(_in_open_keys(every, rare.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("n")).first()["n"]))
    # One row a text is joined with its parities; its keys are rows again only then.
    text = ["digest", "n", "label", *_PARITIES, "u"]
    at = rows.groupBy("digest").agg(F.collect_list(F.struct("key", "minor")).alias("at"))
    texts = at.join(named.select(*text), "digest")
    live = written(texts.withColumn("in_keys", F.transform("at", lambda x: x["key"])), "near-live").select(F.explode("at").alias("k"), "in_keys", *text).select("k.key", "k.minor", "in_keys", *text)
    lead = live.where("minor").select("key", F.col("in_keys").alias("a_keys"), F.struct(*text).alias("x")).select("key", "a_keys", F.col("x.label").alias("la"), *_as_leader("x", [*_PARITIES, "u"]))
    once = F.col("key") == F.array_min(F.array_intersect("a_keys", "in_keys"))
    return live.join(lead, "key").where(_may_link(least) & once).select(F.least("a", "digest").alias("a"), F.greatest("a", "digest").alias("b")).distinct()


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Distinct texts and verified links.

    Texts: digest, id (the least that has it), n_docs, label (the class's least digest).
    Links: a, b (digests), similarity: every pair found, which joins all of a class.
    """
    keyed = docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    members = written(keyed.groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_docs")), "near-texts")
    sketched = written(_sketched(keyed.select("digest", "body")).where("n > 0").dropDuplicates(["digest"]), "near-sketches")
    n_texts = sketched.count()

    def bodies(wanted: DataFrame) -> DataFrame:
        # Each text that is wanted once, whoever holds it.
        one = members.join(wanted, "digest").select(F.col("digest").alias("d"), F.col("id").alias("i"))
        return keyed.join(one, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left_semi").select("digest", "body")

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct()
        pool = written(_with_words(bodies(wanted)).dropDuplicates(["digest"]), "near-words")
        return written(_links(pairs, pool, least), "near-links")

    relabel = lambda x, label: x.join(label.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    stars = written(_stars(sketched.select(F.explode(F.slice("keys", 1, FIRST_FUNCTIONS)).alias("key"), "digest"), sketched, n_texts * FIRST_FUNCTIONS, least), "near-pairs")
    links = verified(stars)
    label = written(components(links), "near-labels")
    cross = _cross(written(relabel(sketched.drop(*_BITS), label), "near-named"), bodies, least, n_texts * FUNCTIONS)
    more = verified(written(cross.join(stars, ["a", "b"], "left_anti"), "near-pairs"))
    # The classes so far are stars; the new links join them.
    label = written(components(more.select("a", "b").unionByName(label.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b")))), "near-labels")
    links = links.unionByName(more)
    told = relabel(members, label)
    return written(told, "near-told"), links


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per distinct text: digest, n_docs of the text, class_id and class_digest, those of the class's least (id, digest), and the class's class_docs and class_texts."""
    told, _ = linked(docs, id_col, text_col, least)
    least_of = told.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("x"), F.col("id").alias("class_id"), F.col("digest").alias("class_digest"))).alias("c"), F.sum("n_docs").alias("class_docs"), F.count(F.lit(1)).alias("class_texts")
    )
    return spread_join(told, least_of, "label", "class_texts", docs.count()).select("digest", "n_docs", "c.class_id", "c.class_digest", "class_docs", "class_texts")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: its least id, then text."""
    digest, found_digest, found_id = (free_name(docs.columns, x) for x in ("digest", "class_digest", "class_id"))
    found = classes(docs, id_col, text_col).where("digest = class_digest").select(F.col("digest").alias(found_digest), F.col("class_id").alias(found_id))
    keyed = docs.withColumn(digest, text_digest(text_col))
    kept = keyed.join(found, (F.col(digest) == F.col(found_digest)) & F.col(id_col).eqNullSafe(F.col(found_id)))
    return kept.dropDuplicates([digest]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_query(docs: DataFrame) -> DataFrame:
    """Every document with its class (its least doc_id), the class's documents and distinct texts."""
    found = classes(docs.select("doc_id", "text")).select(F.col("digest").alias("d"), "class_id", "class_docs", "class_texts")
    return docs.select("doc_id", text_digest("text").alias("d")).join(found, "d").drop("d")
