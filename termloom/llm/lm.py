"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation, and a smoothed unigram base.

Tokens are words between ASCII spaces, with A-Z lower-cased, and one end per text.
Counts of all tokens of all training texts are summed by Spark. The model predicts
events: the end, the most frequent words, and classes of the other words by their
last two bytes. The last ``CONTEXT`` events' vectors, each scaled by its position's
weights, add up to a prediction whose products with all events' vectors, and biases,
give the softmax (Mnih and Hinton, 2007). A word of a class has the class's
probability times (c + 1) / (class tokens + class words + 1), which leaves one share
to unseen words, so all words' probabilities sum to one.

Training sees every training text: each task starts from the same parameters, goes
through its texts once by noise-contrastive estimation with shared noise, and the
tasks' parameters are averaged by their tokens. ``ROUNDS`` passes follow each other.

Words up to ``HEAD_WORDS`` in number, the most frequent ones, have their counts
broadcast; counts of all others are joined by word, so no table grows in a worker.

Defined cases: null and empty texts are one end; a null id is no held-out one; rows
that repeat count and are scored each; without training texts N, V and all counts
are 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import written

CONTEXT = 4
WIDTH = 16
EVENT_WORDS = 255
CLASSES = 64
NOISE = 32
BATCH = 2048
ROUNDS = 1
SAFE_LOGIT = 40.0
HEAD_WORDS = 300_000
#: Words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
END = 0
EVENTS = 1 + EVENT_WORDS + CLASSES
PAD = EVENTS


def tokens_of(text: str | None) -> list[bytes]:
    """A text's words: bytes.lower and bytes.split know ASCII only, as the token rule does."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


class HeadPlaces(dict):
    """Places of the head's words; -1 for others, whose counts are joined."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__((w, i) for i, w in enumerate(words))

    def __missing__(self, word: bytes) -> int:
        return -1


class EventIds(dict):
    """Word to event; a word that is no event of its own has its class's. Bounded: classes of new words are kept up to a limit."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__((w, 1 + i) for i, w in enumerate(words))

    def __missing__(self, word: bytes) -> int:
        found = 1 + EVENT_WORDS + zlib.crc32(word[-2:]) % CLASSES
        if len(self) < HELD_WORDS:
            self[word] = found
        return found


def event_stream(texts: list[list[bytes]], events: EventIds) -> tuple[np.ndarray, np.ndarray]:
    """The events of texts one after the other, each text's end included, and the texts' token counts."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    out = np.empty(sizes.sum(), np.int32)
    at = 0
    get = events.__getitem__
    for t in texts:
        out[at : at + len(t)] = np.fromiter(map(get, t), np.int32, len(t))
        at += len(t)
        out[at] = END
        at += 1
    return out, sizes


def contexts(stream: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The last CONTEXT events before each event, nearest first; before a text's start there are pads."""
    place = np.arange(len(stream)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.full((len(stream), CONTEXT), PAD, np.int32)
    for k in range(CONTEXT):
        out[k + 1 :, k] = stream[: len(stream) - k - 1]
        out[place <= k, k] = PAD
    return out


@dataclass
class Parameters:
    """``before``: vectors of events as context; ``scale``: weights of positions; ``after``, ``bias``: of predicted events."""

    before: np.ndarray
    scale: np.ndarray
    after: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, frequency: np.ndarray, seed: int = 11) -> Parameters:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (EVENTS + 1, WIDTH)).astype(np.float32), np.full((CONTEXT, WIDTH), 1.0 / CONTEXT, np.float32), rng.normal(0, 0.1, (EVENTS, WIDTH)).astype(np.float32), np.log(frequency).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.before, self.scale, self.after, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Parameters:
        shapes = [(EVENTS + 1, WIDTH), (CONTEXT, WIDTH), (EVENTS, WIDTH), (EVENTS,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return cls(*(x.reshape(s).astype(np.float32) for x, s in zip(np.split(np.asarray(flat), cuts), shapes, strict=True)))

    def predicted(self, ctx: np.ndarray) -> np.ndarray:
        q = self.before[ctx[:, 0]] * self.scale[0]
        for k in range(1, CONTEXT):
            q += self.before[ctx[:, k]] * self.scale[k]
        return q

    def log10_probabilities(self, stream: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """The softmax's log10 of each event, by products with all events' vectors, a batch at a time."""
        out = np.empty(len(stream))
        # A prediction's last place is 1 and meets the biases.
        q, turned = np.ones((BATCH, WIDTH + 1), np.float32), np.vstack([self.after.T, self.bias])
        for at in range(0, len(stream), BATCH):
            w = stream[at : at + BATCH]
            q[: len(w), :WIDTH] = self.predicted(ctx[at : at + BATCH])
            logits = q[: len(w)] @ turned
            own = logits[np.arange(len(w)), w].astype(float)
            top = 0.0
            if max(float(logits.max()), -float(logits.min())) > SAFE_LOGIT:  # beyond it single precision's exp may end
                top = logits.max(axis=1)
                logits -= top[:, None]
            np.exp(logits, out=logits)
            out[at : at + BATCH] = own - top - np.log(logits.sum(axis=1))
        return out / np.log(10)


class Trainer:
    """Noise-contrastive estimation over a stream of batches, with Adagrad steps."""

    def __init__(self, start: Parameters, noise: np.ndarray, seed: int = 5, rate: float = 0.1) -> None:
        self.p, self.rate, self.rng = Parameters.of(start.flat()), rate, np.random.default_rng(seed)
        self.noise, self.log_noise, self.edges = noise, np.log(noise * NOISE).astype(np.float32), np.cumsum(noise)
        self.seen = [np.full(x.shape, 1e-3, np.float32) for x in (self.p.before, self.p.scale, self.p.after, self.p.bias)]
        self.tokens = 0

    @staticmethod
    def _into(n: int, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        cells = ids[:, None] * WIDTH + np.arange(WIDTH)
        return np.bincount(cells.ravel(), rows.ravel(), n * WIDTH).reshape(n, WIDTH)

    def learn(self, stream: np.ndarray, ctx: np.ndarray) -> None:
        p = self.p
        for at in range(0, len(stream), BATCH):
            w, c = stream[at : at + BATCH], ctx[at : at + BATCH]
            noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE) * self.edges[-1]), EVENTS - 1)
            r = p.before[c]
            q = np.einsum("bkd,kd->bd", r, p.scale)
            own, other = p.after[w], p.after[noise]
            data = np.einsum("bd,bd->b", q, own) + p.bias[w] - self.log_noise[w]
            false = q @ other.T + p.bias[noise] - self.log_noise[noise]
            g_own = -1 / (1 + np.exp(np.clip(data, -30, 30)))
            g_other = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
            dq = g_own[:, None] * own + g_other @ other
            d_after = self._into(EVENTS, w, g_own[:, None] * q)
            np.add.at(d_after, noise, g_other.T @ q)
            d_bias = np.bincount(w, g_own, EVENTS)
            np.add.at(d_bias, noise, g_other.sum(axis=0))
            d_before = sum(self._into(EVENTS + 1, c[:, k], dq * p.scale[k]) for k in range(CONTEXT))
            d_scale = np.einsum("bd,bkd->kd", dq, r)
            for x, seen, d in zip((p.before, p.scale, p.after, p.bias), self.seen, (d_before, d_scale, d_after, d_bias), strict=True):
                d = (d / len(w)).astype(np.float32)
                seen += d * d
                x -= self.rate * d / np.sqrt(seen)
        self.tokens += len(stream)


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, c: the counts of all words of all rows; a task adds up its own before the shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(tokens_of(text))
            if len(held) > HELD_WORDS:
                yield handed(held)
                held = Counter()
        if held:
            yield handed(held)

    return docs.select(text_col).mapInArrow(rows, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Counted:
    """What the counts say: N, V, end's count, the head words' counts, events' words and tokens, and classes' (tokens, words)."""

    n: int
    v: int
    ends: int
    head: dict[bytes, int]
    events: list[bytes]
    frequency: np.ndarray
    classes: np.ndarray


def summed(counts: DataFrame, ends: int) -> Counted:
    """Bounded summaries of the count table: sums, the most frequent words (HEAD_WORDS at most), the events' words and class sums.

    The head ends between two steps of frequency (exact counts under 1024, then 64 steps to
    a doubling), so it may hold less than its bound, or nothing; counts of words beyond it
    are joined, so results are the same. The events' words don't depend on it.
    """
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(EVENT_WORDS).collect()
    events = [bytes(r["word"]) for r in top]
    step = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor((F.log2("c") - 10) * 64))
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).orderBy(F.desc("step")).collect()
    least, held = None, 0
    for r in steps:
        held += r["n"]
        if held > HEAD_WORDS:
            break
        least = r["least"]
    rows = [] if least is None else counts.where(F.col("c") >= least).collect()
    head = {bytes(r["word"]): r["c"] for r in rows}
    tail = counts.withColumn("k", F.crc32(F.substring("word", -2, 2)) % CLASSES)
    if events:
        tail = tail.where(~F.col("word").isin(events))
    classes = np.zeros((CLASSES, 2))
    for r in tail.groupBy("k").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        classes[r["k"]] = r["c"], r["n"]
    frequency = np.ones(EVENTS)
    frequency[END] += ends
    frequency[1 : 1 + len(events)] += [r["c"] for r in top]
    frequency[1 + EVENT_WORDS :] += classes[:, 0]
    return Counted(int(n) + ends, int(v) + (ends > 0), ends, head, events, frequency / frequency.sum(), classes)


def train(docs: DataFrame, counted: Counted, text_col: str = "text", rounds: int = ROUNDS) -> Parameters:
    """Passes over all rows of ``docs``; each task's parameters come back as one row, summed by Spark, not as text."""
    p = Parameters.start(counted.frequency)
    spark = docs.sparkSession
    for _ in range(rounds):
        held = spark.sparkContext.broadcast((p.flat(), counted.events, counted.frequency))

        def rows(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            flat, words, frequency = held.value
            trainer, events = Trainer(Parameters.of(flat), frequency), EventIds(words)
            for batch in batches:
                stream, sizes = event_stream([tokens_of(t) for t in batch.column(0).to_pylist()], events)
                trainer.learn(stream, contexts(stream, sizes))
            if trainer.tokens:
                out = trainer.p.flat().astype(float) * trainer.tokens
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out) + 1), pa.int32()), pa.array(np.append(out, trainer.tokens))], ["i", "x"])

        got = docs.select(text_col).mapInArrow(rows, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        if got:
            sums = np.zeros(len(got))
            for r in got:
                sums[r["i"]] = r["x"]
            p = Parameters.of(sums[:-1] / sums[-1])
    return p


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns from the rows that aren't held out."""
    spark = docs.sparkSession
    learnt = docs.where(~held_out(id_col))
    counts = written(count_words(learnt, text_col), "lm-counts")
    counted = summed(counts, learnt.count())
    p = train(learnt, counted, text_col, rounds)
    held = spark.sparkContext.broadcast((p.flat(), counted.events, counted.head))
    n, v, ends = counted.n, counted.v, counted.ends
    shares = np.log10(counted.classes.sum(axis=1) + 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, words, head = held.value
        model, events = Parameters.of(flat), EventIds(words)
        # A head word is looked up once, for its event and its count.
        find, event_of = HeadPlaces(list(head)).__getitem__, np.fromiter(map(events.__getitem__, head), np.int32, len(head))
        count_of = np.append(np.fromiter(head.values(), float, len(head)), -1.0)
        logs = np.log10(np.arange(1, 4097))
        for batch in batches:
            texts = [tokens_of(t) for t in batch.column(1).to_pylist()]
            sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
            place, last = np.full(sizes.sum(), -1, np.int64), np.cumsum(sizes) - 1
            tails, at = [], 0
            for t in texts:
                mine = np.fromiter(map(find, t), np.int64, len(t))
                place[at : at + len(t)] = mine
                tails.append([t[i] for i in np.flatnonzero(mine < 0)])
                at += len(t) + 1
            stream = np.append(event_of, END)[place].astype(np.int32)
            beyond = place < 0
            beyond[last] = False
            stream[beyond] = np.fromiter((events[w] for t in tails for w in t), np.int32, int(beyond.sum()))
            c = count_of[place]
            c[last] = ends
            tails = [list(Counter(t).items()) if t else [] for t in tails]
            logp = model.log10_probabilities(stream, contexts(stream, sizes))
            of_class = stream > EVENT_WORDS
            logp[of_class] -= shares[stream[of_class] - 1 - EVENT_WORDS]
            known, here = c > 0, c >= 0
            small = here & (c < 4096)
            log_c = np.zeros(len(c))
            log_c[small] = logs[c[small].astype(np.int64)]
            log_c[here & ~small] = np.log10(c[here & ~small] + 1)
            first = np.cumsum(sizes) - sizes
            add = lambda x, first=first: np.add.reduceat(x, first) if len(first) else np.zeros(0)
            lists = pa.array([[{"word": w, "tf": k} for w, k in t] for t in tails], pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())])))
            columns = [pa.array(sizes), pa.array(add(known.astype(np.int64))), pa.array(add(log_c)), pa.array(add(logp + log_c * of_class)), lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "n_tokens", "n_known", "log_c", "logp", "tail"])

    kind = docs.schema[id_col].dataType.simpleString()
    per = docs.select(id_col, text_col).mapInArrow(rows, f"`{id_col}` {kind}, n_tokens long, n_known long, log_c double, logp double, tail array<struct<word:binary,tf:long>>")
    per = written(per.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rest = per.select("row", F.inline("tail")).join(counts, "word").groupBy("row").agg(F.sum("tf").alias("t_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("t_log_c"))
    added = F.coalesce("t_log_c", F.lit(0.0))
    return per.drop("tail").join(rest, "row", "left").select(
        id_col,
        held_out(id_col).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("t_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_c") + added - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("logp") + added).alias("score"),
    )


def op8_query(docs: DataFrame) -> DataFrame:
    """Scores of every whole text, as op8's contract has it."""
    return score(docs.select("doc_id", "text"))
