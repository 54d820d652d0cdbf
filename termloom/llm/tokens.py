"""Token counts with a digest cache, and word-wise encoders that equal the library's on whole texts.

``count_tokens`` digests each text (null counts as empty; nothing else is
normalised, since other forms may have other counts) and the tokenizer's version,
looks both up in a table of stored counts, encodes only distinct misses, and
appends their counts to the table.

Words repeat far more than texts, so encoders keep a bounded table of words seen:

* ``WordPieces`` (tokenizers): where the file's pipeline is the known one, pre-tokens never
  cross a space, so the ids of a text are those of its stretches between ASCII spaces;
  other files get whole texts;
* ``PieceCounts`` (sentencepiece): where no piece of the model holds a word mark
  after another character, no merge crosses from a character into a following
  space, so counts add up over stretches of "spaces, then other characters". The
  model is tested for this, and other models get whole texts.

Defined cases: null and empty texts are one content with 0 bytes; rows that repeat
share one digest and one encoding; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that an encoder keeps, at about 220 bytes each; when full it goes back to the first of them, which are the frequent ones.
KEPT_WORDS = 500_000
FIRST_WORDS = 100_000
MARK = "▁"
#: Letters, digits and signs below U+0250: each is one composed character, and lower-cases to another (but for U+0130, to two).
PLAIN_WORD = regex.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")


def new_words(seen: dict, split: list[list[str]]) -> list[str]:
    """The words that ``seen`` lacks; makes room for them."""
    new = set().union(*split).difference(seen) if split else set()
    if len(seen) + len(new) > KEPT_WORDS:
        for word in list(islice(seen, FIRST_WORDS, None)):
            del seen[word]
        new = set().union(*split).difference(seen)
    return list(new)


class WordPieces:
    """Ids of texts, as little-endian unsigned 32-bit bytes, by a tokenizers file.

    A plain word's pre-tokens go straight to the file's merge table, where its pipeline
    is the known one (compose, fold spaces, lower-case; split by its pattern, map bytes);
    any other word goes through the whole pipeline, and so does every text of any other file.
    """

    _held: dict[str, WordPieces] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.added = [x["content"] for x in told["added_tokens"]]
        before = told["pre_tokenizer"]["pretokenizers"] if (told["pre_tokenizer"] or {}).get("type") == "Sequence" else []
        steps = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])]
        self.known = steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in before] == ["Split", "ByteLevel"] and before[0]["behavior"] == "Removed" and before[0]["invert"] and not before[1]["add_prefix_space"] and not before[1]["use_regex"]
        if self.known:
            self.find = regex.compile(before[0]["pattern"]["Regex"]).findall
            spell = ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {i: spell.pre_tokenize_str(chr(i))[0][0] for i in range(0x21, 0x250) if PLAIN_WORD.fullmatch(chr(i))}
        self.parts: dict[str, bytes] = {}
        self.seen: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordPieces:
        """The encoder of a file; a worker that runs many tasks loads it once."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) >= KEPT_WORDS:
                self.parts.clear()
            found = self.parts[part] = np.array([x.id for x in self.tokenizer.model.tokenize(part.translate(self.letters))], "<u4").tobytes()
        return found

    def _words(self, words: list[str]) -> Iterator[bytes]:
        match = PLAIN_WORD.fullmatch
        plain = [match(w) is not None for w in words]
        held = " ".join(words)
        if any(a in held for a in self.added):  # special strings, wherever a word holds one
            plain = [p and not any(a in w for a in self.added) for w, p in zip(words, plain, strict=True)]
        rest = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False))
        for w, p in zip(words, plain, strict=True):
            yield b"".join(map(self._part, self.find(w.lower()))) if p else np.array(next(rest).ids, "<u4").tobytes()

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        if not self.known:  # its tokens may cross spaces
            return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = new_words(self.seen, split)
        self.seen.update(zip(new, self._words(new), strict=True))
        get = self.seen.__getitem__
        return [b"".join(map(get, words)) for words in split]


class PieceCounts:
    """Token counts of texts by a sentencepiece model."""

    _held: dict[str, PieceCounts] = {}

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        probe = "  ﬁ　 Ａ  é \n "
        plain = self.model.normalize(probe) == MARK + probe.replace(" ", MARK)
        self.by_words = plain and not any(MARK in p.lstrip(MARK) for p in pieces)
        self.seen: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> PieceCounts:
        """The counter of a model; a worker that runs many tasks loads it once."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_words:
            return self._whole(texts)
        odd = [i for i, t in enumerate(texts) if MARK in t]
        if odd:  # a mark in a text is a space to the model
            texts = list(texts)
            whole = self._whole([texts[i] for i in odd])
            for i in odd:
                texts[i] = ""
            out = self.counts(texts)
            for i, n in zip(odd, whole, strict=True):
                out[i] = n
            return out
        # A stretch stands for its spaces less one: the model puts one mark before every text, as before the first.
        split = [[] if not t else t.split(" ") if "  " not in t and t[0] != " " and t[-1] != " " else [s[1:] for s in re.findall(" +[^ ]+| +$", " " + t)] for t in texts]
        new = new_words(self.seen, split)
        # A lone mark at the end of a text has no stretch text, but one token.
        for word, n in zip(new, self._whole(new), strict=True):
            self.seen[word] = n if word else 1
        get = self.seen.__getitem__
        return [sum(map(get, words)) for words in split]


def version_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file: another version has other counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """digest, n_tokens of each row of ``texts`` (digest, body)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounts.of(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.counts(batch.column(1).to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "body").mapInArrow(rows, "digest binary, n_tokens long")


CACHE = "tokenizer string, digest binary, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens of every row; ``cache`` is the folder of stored counts, made where it is missing.

    A text is carried to its digest's place once for each task that reads it, so copies
    are dropped before the shuffle however many there are.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer)
    spark.createDataFrame([], CACHE).coalesce(1).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    body = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), body.alias("body")).withColumn("digest", F.unhex(F.sha2(F.col("body").cast("binary"), 256)))
    misses = keyed.groupBy("digest").agg(F.first("body").alias("body")).join(stored.select("digest"), "digest", "left_anti")
    encode_counts(misses, tokenizer).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # Two runs at once may both have stored a count; it counts once.
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    sized = keyed.select(id_col, F.octet_length("body").cast("long").alias("n_bytes"), "digest")
    return sized.join(stored, "digest").select(id_col, "n_bytes", "n_tokens")


def op5_query(docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096) -> DataFrame:
    """Counts of every whole text, as op5's contract has it."""
    return count_tokens(docs, tokenizer, cache).withColumn("over_limit", F.col("n_tokens") > limit)
