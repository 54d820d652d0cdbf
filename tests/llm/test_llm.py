"""Corpus operators against brute force, on odd rows, and against SQL."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm import decontam, linededup, lm, media, neardup, packing, queries, sharding, tokens, toxicity, warc
from termloom.llm.common import ranked
from termloom.llm.words import words_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rank int, _r string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", 1, "clash") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, odd characters."""
    rng = random.Random(5)
    body = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) + str(rng.randint(0, 60)) for _ in range(80)) for _ in range(6)]
    rows = [(1, None), (None, "null id"), (None, None), (2, ""), (3, " "), (4, "\n\n"), (5, LONG), (6, body[0]), (6, body[0]), (7, body[0]), (8, body[1] + "\n" + body[2]), (9, body[3] + "\n" + body[2]), (10, "ß É́ <|endoftext|> ▁▁ 日本語 😀"), (11, "x" * 300), (12, body[4]), (13, body[4].replace("alpha", "alpha", 1).replace(body[4].split()[40], "changed", 1))]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# op 1


def test_op1_equals_sql(spark, odd):
    con = duckdb.connect()
    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        pdf = docs.select("doc_id", "text").toPandas()
        con.register("raw", pdf)
        con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text FROM raw")
        want = con.execute(f"SELECT doc_id, text, n_lines, n_removed FROM ({linededup.OP1_SQL})").fetchall()
        assert sorted(map(repr, map(tuple, linededup.op1_query(docs).collect()))) == sorted(map(repr, want))


def test_op1_keeps_one_and_is_native(spark, empty):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(30)) for i in range(8))
    docs = table(spark, [(i, f"own {i} start\n{passage}\nown {i} end") for i in range(20)])
    df = linededup.op1_query(docs)
    got = {r.doc_id: r for r in df.collect()}
    assert passage in got[0].text and got[0].n_removed == 0
    assert all(got[i].n_removed >= 5 and f"own {i} start" in got[i].text for i in range(1, 20))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert linededup.op1_query(empty).count() == 0
    assert linededup.dedup_lines(docs).columns[:8] == docs.columns


def test_op1_finds_passages_of_short_lines(spark, monkeypatch):
    """Passages of 50 words or more go, whatever lines stand around them, in one line or many, once or often; shorter single lines stay."""
    monkeypatch.setattr(linededup, "PART", 3)
    rng = random.Random(2)
    rows, n, want = [], 0, {}
    for k, sizes in enumerate([[50], [60], [30, 30], [25, 25, 25], [10] * 8, [7, 60, 3], [30, 1, 30], [13] * 4]):
        passage = [" ".join(f"p{k}x{i}x{j}" for j in range(w)) for i, w in enumerate(sizes)]
        for copy in range(2 if k % 2 else 9):
            before = [" ".join(f"b{n}x{i}x{j}" for j in range(rng.randint(1, 30))) for i in range(rng.randint(0, 3))]
            after = [" ".join(f"a{n}x{i}x{j}" for j in range(rng.randint(1, 30))) for i in range(rng.randint(0, 3))]
            rows.append((n, "\n".join(before + passage + after)))
            want[n] = "\n".join(before + (passage if not copy else []) + after)
            n += 1
    for _ in range(5):  # one line of 49 words is no passage
        rows.append((n, f"own {n}\n" + " ".join(f"z{j}" for j in range(49)) + f"\nmine {n}"))
        want[n] = rows[-1][1]
        n += 1
    got = {r.doc_id: r.text for r in linededup.op1_query(table(spark, rows)).collect()}
    assert got == want


# op 2


def test_op2_places_every_piece(odd, empty):
    path = queries.vocabulary("word_bpe_49k.json")
    got = packing.pack_documents(odd, path).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    want = Counter()
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[r.doc_id, p, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(seqs) == -(-sum(r.length for r in got) // 4096)
    assert packing.pack_documents(empty, path).count() == 0


def best_fit(sizes, cap):
    """Sequences of best fit, longest first, one by one."""
    loads: list[int] = []
    for s in sorted(sizes, reverse=True):
        fit = [i for i, x in enumerate(loads) if x + s <= cap]
        if fit:
            loads[max(fit, key=lambda i: loads[i])] += s
        else:
            loads.append(s)
    return len(loads)


def test_op2_sweep_is_best_fit():
    rng = random.Random(4)
    for _ in range(50):
        cap = 64
        sizes = [rng.randint(1, cap) for _ in range(rng.randint(1, 200))]
        placed, left, gaps = packing.sweep([(s, 0, n) for s, n in Counter(sizes).items()], [(cap, 0, len(sizes))], cap)
        used = defaultdict(int)
        for length, _, n, first, at, per in placed:
            for k in range(n):
                b = first + k // per
                assert at + (k % per) * length >= 0
                used[b] += length
        assert not left and sum(used.values()) == sum(sizes) and max(used.values()) <= cap
        assert len(used) == best_fit(sizes, cap)


def test_op2_many_lengths(spark):
    rng = random.Random(9)
    sizes = [rng.choice([1, 3, 7, 40, 90, 99]) for _ in range(500)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long")
    got = packing.pack(pieces, 100).collect()
    assert sorted(r.doc_id for r in got) == list(range(500))
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    assert all(sum(x for _, x in s) <= 100 for s in seqs.values())
    assert len(seqs) <= best_fit(sizes, 100)


def test_words_equal_whole_texts():
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    t, w = Tokenizer.from_file(path), tokens.WordPieces(path)
    c = tokens.PieceCounts(queries.vocabulary("piece_bpe_32k.model"))
    assert c.by_words and w.known
    rng = random.Random(1)
    fuzz = ["".join(rng.choice(" \n\tab'é▁<s>/0１ ́İΣß|endoftext") for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["<|endoftext|>x", "a <|startoftext|> b", ""]
    assert [e.ids for e in t.encode_batch(fuzz, add_special_tokens=False)] == [np.frombuffer(x, "<u4").tolist() for x in w.encode_bytes(fuzz)]
    assert c._whole(fuzz) == c.counts(fuzz)


# op 3


def plain_contains(doc, item):
    d, i = ([w for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())] for t in (doc, item))
    return any(d[k : k + len(i)] == i for k in range(len(d) - len(i) + 1)) if i else False


def test_op3_finds_copies_and_substitutions(spark, odd, empty):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [" ".join(word() for _ in range(n)) for n in (1, 4, 11, 12, 15, 30, 60)] + [None, ""]
    hurt = items[6].split()
    for k in range(5, 60, 12):
        hurt[k] = "other"
    docs = table(spark, [(0, "clean text of " + " ".join(word() for _ in range(50)))] + [(i + 1, f"Before {x.upper() if x else ''}, after.") for i, x in enumerate(items)] + [(50, " ".join(hurt)), (51, " ".join(items[6].split()[10:30])), (52, " ".join(items[6].split()[10:18])), (53, None)])
    got = {(r.doc_id, r.item_id) for r in decontam.op3_query(docs, bench(spark, items)).collect()}
    assert got == {(i + 1, i) for i in range(7)} | {(50, 6), (51, 6)}
    kept = {r.doc_id for r in decontam.clean(docs, bench(spark, items)).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in got}
    assert decontam.op3_query(empty, bench(spark, items)).count() == 0
    assert decontam.op3_query(odd, bench(spark, [])).count() == 0
    assert decontam.clean(odd, bench(spark, [])).columns == odd.columns


def test_op3_masks_hit_every_pattern():
    """No choice of at most a fifth of the words, changed, escapes: in whole items of 1 to 12 words, and in stretches of 13 to 25."""
    for n in range(1, 26):
        masks = decontam.MASKS if n >= 13 else decontam.short_masks(n)
        fits = [sum(1 << (at + k) for k, c in enumerate(m) if c == "1") for m in masks for at in range(n - len(m) + 1)]
        for out in itertools.combinations(range(n), n // 5):
            changed = sum(1 << k for k in out)
            assert any(f & changed == 0 for f in fits), (n, out)


def test_op3_finds_every_pattern_of_a_short_item():
    for n in (5, 11, 12, 13, 15):
        item = [f"w{k}" for k in range(n)]
        texts = [" ".join(["before", *("x" if k in out else w for k, w in enumerate(item)), "after"]) for out in itertools.combinations(range(n), n // 5)]
        index = decontam.build_index([1], [" ".join(item)])
        assert {m[0] for m in decontam.search_texts(index, texts)} == set(range(len(texts)))
        # One change more: no overlap, unless the item is so long that a part of it counts.
        over = " ".join("x" if k <= n // 5 else w for k, w in enumerate(item))
        assert n > 13 or decontam.search_texts(index, [over]) == []


def test_op3_stretch_equals_all_stretches():
    """A stretch is found where one of all stretches of 13 words or more is alike."""
    rng = random.Random(12)
    cases = [[True] * 12 + [False] + [True] * 3 + [False] * 14] + [[rng.random() < rng.choice((0.5, 0.7, 0.8, 0.9)) for _ in range(rng.randint(1, 45))] for _ in range(1500)]
    for same in cases:
        alike = {(a, b) for a in range(len(same)) for b in range(a + 13, len(same) + 1) if 5 * sum(same[a:b]) >= 4 * (b - a)}
        got = decontam._best(np.array(same), 0.8, 13, False)
        assert got in alike if alike else got is None


def test_op3_finds_a_stretch_with_a_change_near_its_end():
    item = [f"w{k}" for k in range(30)]
    text = " ".join([*item[:12], "x", *item[13:16], "other", "words", "come", "then"])
    got = decontam.search_texts(decontam.build_index([1], [" ".join(item)]), [text])
    assert len(got) == 1 and got[0][4] >= 13 and got[0][5] / got[0][4] >= 0.8


def test_op3_equals_brute_force(spark, small):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    b = [(r.item_id, r.text) for r in items.collect()]
    want = {(r.doc_id, i) for r in small.collect() for i, t in b if plain_contains(r.text, t)}
    got = {(r.doc_id, r.item_id) for r in decontam.op3_query(small, items).where("identity = 1 and n_words > 14").collect()}
    assert want and want <= got | {x for x in want if len(dict(b)[x[1]].split()) < 15}


def test_op3_words_that_repeat():
    """n equal words in a text and an item: hits grow with n, not with its square, and the overlap is the whole."""
    for n in (20, 3000):
        index = decontam.build_index([1, 2], [" ".join(["same"] * n), "a b " * (n // 2)])
        got = decontam.search_texts(index, [" ".join(["same"] * (n + 5)), "a b " * n, "b a " * (n // 2)])
        best = {(t, i): (words, equal) for t, i, _, _, words, equal in got}
        assert best[0, 0] == (n, n) and best[1, 1] == (n, n) and best[2, 1][1] >= n - 1 and set(best) == {(0, 0), (1, 1), (2, 1)}


def test_op3_overlaps_equal_plain_search():
    """Substituted copies of items in texts: what is found equals every overlap by plain code, diagonal by diagonal."""
    rng = random.Random(31)
    words = [f"w{k}" for k in range(40)]
    items = [[rng.choice(words) for _ in range(rng.choice((3, 9, 14, 20, 45)))] for _ in range(25)]
    texts = []
    for _ in range(120):
        it = rng.choice(items)
        a = rng.randint(0, max(0, len(it) - 13)) if rng.random() < 0.4 else 0
        part = [rng.choice(words) if rng.random() < rng.choice((0, 0.1, 0.25)) else w for w in it[a:]]
        texts.append([rng.choice(words) for _ in range(rng.randint(0, 30))] + part + [rng.choice(words) for _ in range(rng.randint(0, 30))])
    want = set()
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            for shift in range(-len(item) + 1, len(text)):
                lo, hi = max(0, -shift), min(len(item), len(text) - shift)
                same = [text[k + shift] == item[k] for k in range(lo, hi)]
                whole = (lo, hi) == (0, len(item)) and 5 * sum(same) >= 4 * len(same)
                part = any(5 * sum(same[a:b]) >= 4 * (b - a) for a in range(len(same)) for b in range(a + 13, len(same) + 1))
                if whole or (part and len(item) >= 13):
                    want.add((t, i))
    got = decontam.search_texts(decontam.build_index(list(range(len(items))), [" ".join(x) for x in items]), [" ".join(x) for x in texts])
    assert {m[:2] for m in got} == want


def test_op3_blocks_are_one(spark, small):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontam.matches(small, items).collect()))
    old = decontam.indexes.__defaults__
    decontam.indexes.__defaults__ = (*old[:-1], 100)
    try:
        assert len(list(decontam.indexes(items))) > 1
        assert sorted(map(tuple, decontam.matches(small, items).collect())) == whole
    finally:
        decontam.indexes.__defaults__ = old


# op 4


def test_op4_round_trip_and_audit(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.createDataFrame([(None, None, None), (3, "http://x", ""), (3, "http://x", "")], "page_id long, url string, html string"))
    warc.write_warc(pages, str(tmp_path / "w"), 3)
    got = warc.read_warc(spark, str(tmp_path / "w/part-*")).collect()
    assert all(r.error is None for r in got)
    assert Counter((r.uri, bytes(r.content).decode()) for r in got) == Counter((r.url or "", r.html or "") for r in pages.collect())
    leaf = warc.leaves(pages)
    assert warc.audit(warc.trees(leaf, leaf, 3)).count() == 0
    hurt = pages.withColumn("html", F.when(F.col("page_id").isin(5, 17), F.concat("html", F.lit("!"))).otherwise(F.col("html")))
    assert {r.page_id for r in warc.fixity(pages, hurt).where("damaged").collect()} == {5, 17}
    same = pages.withColumn("html", F.when(F.col("page_id") == 5, F.overlay("html", F.lit("~"), F.lit(1))).otherwise(F.col("html")))
    assert {r.page_id for r in warc.fixity(pages, same).where("damaged").collect()} == {5}
    assert warc.op4_query(pages.where("false")).count() == 0
    # A record that the replica lacks condemns no other; one that it has too many is found there.
    assert [r.page_id for r in warc.fixity(pages, pages.where("page_id != 20 OR page_id IS NULL")).where("damaged").collect()] == [20]
    assert [r.page_id for r in warc.surplus(pages.where("page_id != 20 OR page_id IS NULL"), pages).collect()] == [20]
    assert warc.surplus(pages, pages).count() == 0
    twice = pages.unionByName(pages.where("page_id = 7"))
    assert [r.page_id for r in warc.surplus(pages, twice).collect()] == [7] and warc.fixity(twice, pages).where("damaged").count() == 1


def test_op4_odd_pages_against_plain_tree(spark):
    """Nulls, empties, clashing columns, a hot page and a very long one; every digest by plain code."""
    rows = [(None, None, None), (None, None, "x"), (None, "u", None), (1, "u", ""), (1, "u", "long " * 200_000)] + [(2, "hot", f"v{i % 40}") for i in range(700)] + [(i, f"http://h/{i}", "é" * i) for i in range(10, 60)]
    pages = spark.createDataFrame([(*r, 1, "clash") for r in rows], "page_id long, url string, html string, place int, segment string")
    got = warc.fixity(pages, pages.where("page_id IS NULL OR page_id != 30")).collect()
    assert len(got) == len(rows) and [r.page_id for r in got if r.damaged] == [30]

    def record(p, u, h):
        body, m = (h or "").encode(), hashlib.md5("|".join(str(x) for x in (p, u or "") if x is not None).encode()).hexdigest()
        name = "-".join((m[:8], m[8:12], m[12:16], m[16:20], m[20:32]))
        return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Target-URI: {u or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    told = defaultdict(list)
    for p, u, h in rows:
        data = record(p, u, h)
        told[p, u or ""].append((hashlib.sha256(data).hexdigest(), len(data)))
    leaf = sorted((int(hashlib.md5(f"{'-' if p is None else p}|{u}|{n}".encode()).hexdigest()[:15], 16), -1 if p is None else p, u, n, size, sha) for (p, u), v in told.items() for n, (sha, size) in enumerate(sorted(v)))
    digits = warc.segment_digits(len(rows))
    assert digits == 1

    def node(digits_, prefix):
        mine = [x for x in leaf if x[0] >> (3 * (warc.DIGITS - digits_)) == prefix]
        if not mine:
            return None
        if digits_ == digits + warc.RANGE_LEVELS:
            at, out = 0, "range"
            for place, *_, size, sha in mine:
                out = hashlib.sha256(f"{out}:{place}:{at}:{size}:{sha}".encode()).hexdigest()
                at += size
            return out
        kids = [(k, node(digits_ + 1, prefix * 8 + k)) for k in range(8)]
        return hashlib.sha256(("node:" + ":".join(f"{k}={h}" for k, h in kids if h)).encode()).hexdigest()

    want, at, slot = Counter(), defaultdict(int), defaultdict(int)
    for place, p, _, _, size, sha in leaf:
        s = place >> (3 * (warc.DIGITS - digits))
        want[None if p == -1 else p, s, slot[s], at[s], size, sha, node(digits, s)] += 1
        at[s] += size
        slot[s] += 1
    assert Counter((r.page_id, r.segment, r.slot, r.offset, r.length, r.record_sha256, r.segment_root) for r in got) == want


def test_op4_parse_is_safe():
    body = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [(o, n, c, e) for o, n, _, c, e in warc.parse_warc(body * 2)] == [(0, len(body), b"abc", None), (len(body), len(body), b"abc", None)]
    import gzip

    assert [c for *_, c, _ in warc.parse_warc(gzip.compress(body) + gzip.compress(body))] == [b"abc"] * 2
    assert list(warc.parse_warc(body[:-6]))[-1][4] == "record is cut off"
    assert list(warc.parse_warc(b"junk"))[0][4] == "no record header"
    assert list(warc.parse_warc(b"")) == []


# op 5


def test_op5_counts_and_cache(spark, odd, empty, tmp_path):
    path, cache = queries.vocabulary("piece_bpe_32k.model"), str(tmp_path / "cache")
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    got = tokens.op5_query(odd, path, cache).collect()
    want = sorted(((r.doc_id or -1), len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert [r.over_limit for r in got if r.n_tokens > 4096] == [True]
    n = spark.read.parquet(cache).count()
    assert n == len({r.text or "" for r in odd.collect()})
    assert tokens.op5_query(odd, path, cache).count() == odd.count()
    assert spark.read.parquet(cache).count() == n
    assert tokens.op5_query(empty, path, str(tmp_path / "none")).count() == 0


def test_op2_other_files_get_whole_texts(tmp_path):
    """A file whose tokens hold a leading space."""
    from tokenizers import Tokenizer, models

    t = Tokenizer(models.BPE(vocab={"a": 0, " ": 1, " a": 2}, merges=[(" ", "a")]))
    path = str(tmp_path / "t.json")
    t.save(path)
    texts = ["a a", "a", "", " a a"]
    assert tokens.WordPieces(path).encode_bytes(texts) == [np.array(t.encode(x).ids, "<u4").tobytes() for x in texts]


def test_op5_counts_stored_twice_count_once(spark, tmp_path):
    docs, path, cache = table(spark, [(1, "one two"), (2, "one two"), (3, None)]), queries.vocabulary("piece_bpe_32k.model"), str(tmp_path / "c")
    first = sorted(map(tuple, tokens.count_tokens(docs, path, cache).collect()))
    held = spark.read.parquet(cache)
    held.write.mode("append").parquet(cache)
    assert spark.read.parquet(cache).count() == 4
    assert sorted(map(tuple, tokens.count_tokens(docs, path, cache).collect())) == first


# op 6


def test_op6_jump(odd, empty):
    def plain(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    keys = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [plain(int(k), n) for k in keys]
    rows = sharding.op6_query(odd).collect()
    assert len(rows) == odd.count()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert sharding.op6_query(empty).count() == 0


def test_op6_files(spark, small, tmp_path):
    sharding.write_shards(small, str(tmp_path / "s"), 4, spread=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == small.count() and set(back.columns) == {*small.columns, "shard"}


def test_ranks(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.randint(0, 5)) for _ in range(400)]
    got = ranked(spark.createDataFrame(rows, "g string, x int"), ["g"], ["x"]).collect()
    by = defaultdict(list)
    for r in got:
        by[r.g].append((r["rank"], r.x))
    for s in by.values():
        s.sort()
        assert [k for k, _ in s] == list(range(len(s))) and [x for _, x in s] == sorted(x for _, x in s)


# op 7


def test_op7_round_trip(spark, odd, empty):
    got = media.op7_query(odd).collect()
    assert len(got) == odd.count()
    want = Counter()
    for r in odd.collect():
        b = (r.text or "").encode()
        p = b + bytes(-len(b) % 64 if b else 64)
        want[r.doc_id, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    assert media.op7_query(empty).count() == 0
    file = media.build_container(bytes(range(64)) * 40)
    cols = media.media_columns(spark.createDataFrame([(1, bytearray(file)), (2, None), (3, bytearray(file[:-9])), (4, bytearray(b"")), (5, bytearray(b"\0\0\0\x07free"))], "k int, content binary"), "k").collect()
    by = {r.k: r for r in cols}
    assert (by[1].codec, by[1].samples, by[1].duration, by[1].error) == ("raw ", 40, 1600, None)
    at = file.index(b"mdat") + 4
    assert [(k.start - at, k.end - at) for k in by[1].keyframes] == [(0, 64), (32 * 64, 33 * 64)]
    assert by[2].error == "no bytes" and by[3].error and by[5].error and by[4].error is None


def test_op7_reads_other_tables():
    # Two samples in two chunks, 64-bit offsets, sizes of their own, no list of keyframes.
    full = lambda k, *p: media._full(k, *p)
    import struct

    def movie(a, b):
        stbl = media._box(b"stbl", full(b"stsd", struct.pack(">I", 1), media._box(b"mp4a", bytes(28))), full(b"stts", struct.pack(">III", 1, 2, 5)), full(b"stsc", struct.pack(">IIII", 1, 1, 1, 1)), full(b"stsz", struct.pack(">IIII", 0, 2, 3, 4)), full(b"co64", struct.pack(">IQQ", 2, a, b)))
        mdhd = media._full(b"mdhd", struct.pack(">QQIQI", 0, 0, 48000, 10, 0), version=1)
        return media._box(b"moov", media._box(b"trak", media._box(b"mdia", mdhd, media._box(b"minf", stbl))))

    n = len(movie(0, 0))
    head = struct.pack(">I4sQ", 1, b"mdat", 16 + 12)
    file = movie(n + 16, n + 16 + 8) + head + b"abc.....defg"
    t = media.parse_container(file)
    assert t["error"] is None
    (track,) = t["tracks"]
    assert (track["codec"], track["timescale"], track["duration"]) == ("mp4a", 48000, 10)
    assert media.read_samples(file, track) == b"abcdefg" and len(track["key_starts"]) == 2


def test_op7_reads_fragments():
    import struct

    full, box = media._full, media._box
    entry = box(b"mp4a", bytes(28))
    stbl = box(b"stbl", full(b"stsd", struct.pack(">I", 1), entry), full(b"stts", struct.pack(">I", 0)), full(b"stsc", struct.pack(">I", 0)), full(b"stsz", struct.pack(">II", 0, 0)), full(b"stco", struct.pack(">I", 0)))
    trak = box(b"trak", full(b"tkhd", struct.pack(">IIIII", 0, 0, 5, 0, 0)), box(b"mdia", full(b"mdhd", struct.pack(">IIIII", 0, 0, 100, 0, 0)), box(b"minf", stbl)))
    moov = box(b"moov", trak, box(b"mvex", full(b"trex", struct.pack(">IIIII", 5, 1, 7, 3, 0x10000))))

    def moof(offset, flags, *rows, first=None):
        head = struct.pack(">I", len(rows)) + struct.pack(">i", offset) + (b"" if first is None else struct.pack(">I", first))
        run = full(b"trun", head, b"".join(struct.pack(f">{len(r)}I", *r) for r in rows), flags=flags | 1 | (4 if first is not None else 0))
        return box(b"moof", box(b"traf", full(b"tfhd", struct.pack(">I", 5), flags=0x20000), run))

    a = moof(0, 0x300, (10, 4), (20, 2), first=0)
    a = moof(len(a) + 8, 0x300, (10, 4), (20, 2), first=0)
    b = moof(0, 0, (), ())
    b = moof(len(b) + 8, 0, (), ())
    file = moov + a + box(b"mdat", b"abcdef") + b + box(b"mdat", b"ghijkl")
    t = media.parse_container(file)
    assert t["error"] is None
    (track,) = t["tracks"]
    assert media.read_samples(file, track) == b"abcdefghijkl" and track["sizes"].tolist() == [4, 2, 3, 3]
    assert track["duration"] == 10 + 20 + 7 + 7 and [file[x:y] for x, y in zip(track["key_starts"], track["key_ends"])] == [b"abcd"]
    assert media.parse_container(moov + moof(8, 0x200, (1 << 30,)))["error"] == "samples outside the file"


def test_op7_claims_take_no_memory():
    import struct
    import tracemalloc

    for table in (media._full(b"stsz", struct.pack(">II", 1, 400_000_000)), media._full(b"stsz", struct.pack(">II", 0, 400_000_000)), media._full(b"stts", struct.pack(">I", 400_000_000))):
        stbl = media._box(b"stbl", table, media._full(b"stsc", struct.pack(">IIIIIII", 2, 1, 1, 1, 4_000_000_000, 1, 1)), media._full(b"stco", struct.pack(">II", 1, 0)))
        file = media._box(b"moov", media._box(b"trak", media._box(b"mdia", media._box(b"minf", stbl))))
        tracemalloc.start()
        assert media.parse_container(file)["error"]
        assert tracemalloc.get_traced_memory()[1] < 1_000_000
        tracemalloc.stop()


# op 8


@pytest.mark.parametrize("head", [300_000, 20])
def test_op8_base_and_normalised(odd, small, empty, head, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["\n"]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    for docs in (odd, small) if head > 20 else (small,):
        rows = docs.collect()
        c = Counter(w for r in rows if not held(r.doc_id) for w in words(r.text))
        n, v = sum(c.values()), len(c)
        want = sorted((r.doc_id if r.doc_id is not None else -1, held(r.doc_id), len(words(r.text)), sum(c[w] > 0 for w in words(r.text)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(r.text)), 4)) for r in rows)
        got = lm.op8_query(docs).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(r.score < 0 for r in got)
    if head > 20:
        assert lm.op8_query(empty).count() == 0


def test_op8_events_do_not_depend_on_the_head(spark, monkeypatch):
    """More frequent words than the head may hold: the events stay, and so do all results."""
    counts = spark.createDataFrame([(f"w{k:05d}".encode(), 100_000 if k < 3000 else k % 7 + 1) for k in range(6000)], "word binary, c long")
    whole = lm.summed(counts, 5)
    monkeypatch.setattr(lm, "HEAD_WORDS", 1000)
    few = lm.summed(counts, 5)
    assert len(whole.head) == 6000 and len(few.head) == 0 and len(few.events) == lm.EVENT_WORDS
    assert few.events == whole.events == [f"w{k:05d}".encode() for k in range(lm.EVENT_WORDS)]
    assert np.array_equal(few.frequency, whole.frequency) and np.array_equal(few.classes, whole.classes)


def test_op8_score_is_the_models(spark, small):
    """Every score by plain loops over the trained parameters."""
    docs = small.limit(40).select("doc_id", "text").coalesce(1).cache()
    learnt = docs.where(~lm.held_out())
    counts = lm.count_words(learnt)
    counted = lm.summed(counts, learnt.count())
    p = lm.train(learnt, counted)
    c = {bytes(r.word): r.c for r in counts.collect()}
    place = {w: 1 + i for i, w in enumerate(counted.events)}
    event = lambda w: place.get(w, 1 + lm.EVENT_WORDS + zlib.crc32(w[-2:]) % lm.CLASSES)
    got = {r.doc_id: r.score for r in lm.op8_query(docs).collect()}
    for r in docs.collect():
        words = [x for x in re.split(rb"[\x20\x09-\x0D]+", (r.text or "").encode().lower()) if x]
        events, total = [event(w) for w in words] + [lm.END], 0.0
        for i, e in enumerate(events[:400]):
            before = [events[i - 1 - k] if i - 1 - k >= 0 else lm.PAD for k in range(lm.CONTEXT)]
            q = sum(p.before[b].astype(float) * p.scale[k] for k, b in enumerate(before))
            logits = p.after.astype(float) @ q + p.bias
            top = logits.max()
            total += (logits[e] - top - math.log(np.exp(logits - top).sum())) / math.log(10)
            if e > lm.EVENT_WORDS:
                tokens, kinds = counted.classes[e - 1 - lm.EVENT_WORDS]
                total += math.log10((c.get(words[i], 0) + 1) / (tokens + kinds + 1))
        if len(events) <= 400:
            assert got[r.doc_id] == pytest.approx(total, rel=1e-3, abs=1e-2)


def test_op8_model_learns_and_sums_to_one():
    rng = np.random.default_rng(3)
    text = [bytes([97 + k]) for k in rng.integers(0, 8, 4000).cumsum() % 8]
    ids = lm.EventIds([bytes([97 + k]) for k in range(8)])
    stream, sizes = lm.event_stream([text], ids)
    ctx = lm.contexts(stream, sizes)
    f = np.bincount(stream, minlength=lm.EVENTS) + 1.0
    t = lm.Trainer(lm.Parameters.start(f / f.sum()), f / f.sum())
    every = [t.p.log10_probabilities(np.full(1, e, np.int32), ctx[50:51])[0] for e in range(lm.EVENTS)]
    assert abs(sum(10**x for x in every) - 1) < 1e-4
    order = [b"a", b"b"] * 3000
    stream, sizes = lm.event_stream([order], ids)
    ctx = lm.contexts(stream, sizes)
    before = t.p.log10_probabilities(stream, ctx).mean()
    for _ in range(5):
        t.learn(stream, ctx)
    assert t.p.log10_probabilities(stream, ctx).mean() > before + 0.1


# op 9


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_similarity(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(p[j] + 1 if x == y else max(p[j + 1], q[j]))
        p = q
    return p[-1] / (len(a) + len(b) - p[-1]) if a and b else 0.0


def plain_classes(rows):
    """Least id of each component over links of 0.8 or more that share half of their distinct words, and equal texts."""
    texts = sorted({t or "" for _, t in rows})
    units = {t: plain_words(t) for t in texts}
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            ca, cb = Counter(units[a]), Counter(units[b])
            m = sum((ca & cb).values())
            both, all_ = len(ca.keys() & cb.keys()), len(ca.keys() | cb.keys())
            if m and 2 * both >= all_ and m >= 0.8 * (len(units[a]) + len(units[b]) - m) and plain_similarity(units[a], units[b]) >= 0.8:
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for d, t in rows:
        ids[find(t or "")].append(d)
    least = {k: min([x for x in v if x is not None], default=None) for k, v in ids.items()}
    return Counter((d, least[find(t or "")]) for d, t in rows)


def test_op9_equals_brute_force(spark, odd, empty):
    rng = random.Random(6)
    word = lambda: rng.choice("ka lo mi nu pe ra so tu".split()) + rng.choice("ka lo mi nu pe ra so tu".split()) + str(rng.randint(0, 30))
    rows, n = [(r.doc_id, r.text) for r in odd.collect()], 100
    for _ in range(12):
        base = [word() for _ in range(rng.randint(60, 250))]
        for copy in range(6):
            w = base[:]
            for _ in range(copy):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [word()], [w[k], word()]])
            rows.append((n, " ".join(w)))
            n += 1
    shared = " ".join(word() for _ in range(60))
    for _ in range(25):
        rows.append((n, shared + " " + " ".join(word() for _ in range(rng.randint(20, 60)))))
        n += 1
    docs = table(spark, rows)
    got = Counter((r.doc_id, r.class_id) for r in neardup.op9_query(docs).collect())
    assert got == plain_classes(rows)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c: 1 for _, c in plain_classes(rows)})
    assert neardup.op9_query(empty).count() == 0 and neardup.keep_one(empty).count() == 0


def test_op9_links_to_members_that_do_not_lead(spark):
    """A tight group, and a text that is a link of one of its members only."""
    rng, rows, alone = random.Random(11), [], 0
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(220)]
        copies = [base] + [[*base[:k], f"g{g}c{k}", *base[k + 1 :]] for k in range(20, 200, 20)]
        member = [*base[:105], f"g{g}m", *base[106:]]
        z, places = member[:], [k for k in range(220) if abs(k - 105) > 9]
        rng.shuffle(places)
        for k in places:
            more = [*z[:k], f"g{g}z{k}", *z[k + 1 :]]
            if plain_similarity(plain_words(" ".join(more)), plain_words(" ".join(member))) < 0.8:
                continue
            z = more
        near = [plain_similarity(plain_words(" ".join(z)), plain_words(" ".join(x))) for x in (member, *copies)]
        assert near[0] >= 0.8
        alone += max(near[1:]) < 0.8
        rows += [(1000 * g + i, " ".join(x)) for i, x in enumerate([*copies, member, z])]
    assert alone >= 6
    got = Counter((r.doc_id, r.class_id) for r in neardup.op9_query(table(spark, rows)).collect())
    assert got == Counter((d, d // 1000 * 1000) for d, _ in rows)


def test_op9_alignment():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randint(0, 5 + rng.randint(0, 30)) for _ in range(rng.randint(1, 40))]
        b = a[:]
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(b)) if b else 0
            b[k : k + 1] = rng.choice([[], [99], [77, 78]])
        s = plain_similarity(a, b)
        if 2 * len(set(a) & set(b)) < len(set(a) | set(b)):
            s = 0
        assert neardup.similarity(np.array(a, np.uint32), np.array(b, np.uint32)) == pytest.approx(s if s >= 0.8 else 0)
    # More rows than one table of places serves, and words by place tables of both kinds.
    for n in (700, 6000):
        a = [rng.randint(0, 400) for _ in range(n)]
        b = a[:]
        for _ in range(n // 20):
            k = rng.randrange(len(b))
            b[k : k + 1] = rng.choice([[], [rng.randint(0, 400)], [401, 402]])
        assert neardup._common(np.array(a), np.array(b), len(b)) >= neardup._common(np.array(a), np.array(b), n // 9)
        assert neardup.similarity(np.array(a), np.array(b)) == pytest.approx(plain_similarity(a, b) if n < 1000 else neardup._common(np.array(a), np.array(b), len(b)) / (len(a) + len(b) - neardup._common(np.array(a), np.array(b), len(b))))


def test_op9_finds_links_by_number_of_edits():
    """Of pairs that are links, the share with a key in common whose word bits pass, for texts of 60 to 800 words."""
    rng = random.Random(17)
    for n, edits in ((60, 3), (60, 6), (200, 10), (200, 20), (800, 40), (800, 80)):
        found = total = 0
        for _ in range(60):
            a = [f"w{rng.randint(0, 3000)}" for _ in range(n)]
            b = a[:]
            for k in rng.sample(range(n), edits):
                b[k] = f"new{rng.randint(0, 10**6)}"
            if not neardup.similarity(np.array([hash(x) & 0xFFFFFFFF for x in a], np.uint32), np.array([hash(x) & 0xFFFFFFFF for x in b], np.uint32)):
                continue
            total += 1
            keys, _, bits = neardup.sketches([" ".join(a), " ".join(b)])
            apart = [int(x).bit_count() for x in (bits[0] ^ bits[1])]
            found += bool((keys[0] == keys[1]).any()) and apart[0] + apart[1] <= neardup.BITS_APART[0] and apart[2] + apart[3] <= neardup.BITS_APART[1]
        assert total >= 50 and found >= 0.9 * total, (n, edits, found, total)


def test_op9_repeated_words_are_no_likeness(spark):
    """Texts that only share a pair of words said hundreds of times aren't copies; a deal of large keys loses no link."""
    rng = random.Random(21)
    said = " ".join(["so it"] * 300)
    own = [[f"t{i}w{k}" for k in range(80)] for i in range(40)]
    rows = [(i, " ".join(own[i]) + " " + said) for i in range(40)]
    rows += [(100 + i, " ".join([*own[i][:40], f"c{i}", *own[i][41:]]) + " " + said) for i in range(40)]
    rng.shuffle(rows)
    want = Counter((d, d % 100) for d, _ in rows)
    got = neardup.op9_query(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == want
    assert {(r.class_docs, r.class_texts) for r in got} == {(2, 2)}


def test_op9_large_keys_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(neardup, "DEALT", 4)
    rng = random.Random(5)
    shared = " ".join(f"s{k}" for k in range(70))
    rows = []
    for i in range(60):
        own = [f"t{i}w{rng.randint(0, 10**6)}" for _ in range(40)]
        rows += [(i, shared + " " + " ".join(own)), (100 + i, shared + " " + " ".join([*own[:9], "x", *own[10:]]))]
    got = Counter((r.doc_id, r.class_id) for r in neardup.op9_query(table(spark, rows)).collect())
    assert got == Counter((d, d % 100) for d, _ in rows) == plain_classes(rows)


def links_of_many_kinds(seed):
    """Pairs of texts that share a passage with all others: few words changed, or so many that just half of the distinct words stay."""
    rng, rows = random.Random(seed), []
    shared, said = " ".join(f"s{k}" for k in range(70)), " ".join(["so it"] * 120)
    for i in range(40):
        own = [f"t{i}w{rng.randint(0, 10**6)}" for _ in range(40)]
        changed = [f"c{i}x{k}" if k % (9 if i % 2 else 4) == 0 else x for k, x in enumerate(own)]
        for d, w in ((i, own), (100 + i, changed)):
            rows.append((d, (shared if i % 2 else said) + " " + " ".join(w)))
    return rows


def test_op9_finds_links_whose_word_bits_differ(spark, monkeypatch):
    """MinHash bits only choose what is compared first: no pair passes them here, and no link is lost."""
    monkeypatch.setattr(neardup, "BITS_APART", (-1, -1))
    rows = links_of_many_kinds(8)
    want = plain_classes(rows)
    assert want == Counter((d, d % 100) for d, _ in rows)
    assert Counter((r.doc_id, r.class_id) for r in neardup.op9_query(table(spark, rows)).collect()) == want
    # In large keys too.
    monkeypatch.setattr(neardup, "DEALT", 1)
    assert Counter((r.doc_id, r.class_id) for r in neardup.op9_query(table(spark, rows)).collect()) == want


def test_op9_bounds_hold_for_every_link():
    """Parities and rare words of random links, many of them at the threshold."""
    rng, total = random.Random(31), 0
    for _ in range(400):
        n = rng.choice((1, 2, 4, 5, 9, 10, 30, 100, 400))
        a = [f"w{rng.randint(0, n)}" for _ in range(n)]
        b = a[:]
        for _ in range(rng.randint(0, n // 8 + 1)):
            k = rng.randrange(len(b)) if b else 0
            b[k : k + 1] = rng.choice([[], [f"x{rng.randint(0, 9**9)}"], ["w1", f"y{rng.randint(0, 9**9)}"]])
        w = words_of([" ".join(a), " ".join(b)])
        h = w.hashes()
        if not neardup.similarity(h[: len(a)], h[len(a) :]):
            continue
        total += 1
        bits = neardup.sketches([" ".join(a), " ".join(b)])[2]
        apart = [int(x).bit_count() for x in bits[0] ^ bits[1]]
        assert 9 * sum(apart[6:22]) <= len(a) + len(b) and 3 * sum(apart[22:30]) <= len(set(a)) + len(set(b))
        assert [int(x) for x in bits[:, 30]] == [len(set(a)), len(set(b))]
        counts = np.random.default_rng(total).integers(0, 4, 1 << neardup.COUNT_BITS)
        rare, first = neardup.rare_first(neardup.labelled(h, w.first)[0], w.first, counts, 0.8)
        assert len(rare) == first[-1] and set(rare[: first[1]].tolist()) & set(rare[first[1] :].tolist()), (a, b)
    assert total >= 150


def test_op9_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 240)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in neardup.components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


# op 10


def toxic_rows(n, seed):
    rng = random.Random(seed)
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 300))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zxqwerty", "vlkmonstr"]) + rng.choice(["", "a", "en", "ity"]))
        out.append((i, " ".join(w), int(bad)))
    return out


def test_op10_learns_and_generalises(spark, odd, empty):
    rows = toxic_rows(400, 1)
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(9000, rows[1][1] + " zxqwertyzz " + rows[2][1]), (9001, None), (9002, ""), (9003, LONG)])
    got = {r.doc_id: r for r in toxicity.op10_query(docs, labels(spark, [(i, 1, y) for i, _, y in rows] + [(9002, 1, None)])).collect()}
    assert len(got) == docs.count()
    test = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r.held_out for r, _ in test)
    assert sum(r.predicted == y for r, y in test) >= 0.95 * len(test)
    assert got[9000].predicted == 1  # a spelling that no label had
    assert got[9001].score == got[9002].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert toxicity.op10_query(empty, labels(spark, [(1, 1, 1)])).count() == 0
    assert {r.score for r in toxicity.op10_query(odd, labels(spark, [])).collect()} == {0.0}


def test_op10_score_is_the_models():
    """Every score by plain loops over the trained vectors; a long text's segments go on over the parts that it is worked on in."""
    rows = toxic_rows(60, 2)
    m = toxicity.train([t for _, t, _ in rows], [y for *_, y in rows], steps=60, refine=60)
    assert np.allclose(m.grams, m.embeddings @ (m.softmax[:, 1] - m.softmax[:, 0]), atol=1e-4)

    def bucket(gram):
        h = len(gram)
        for x in gram:
            h = (h * 0x100000001B3 + x) % 2**64
        return (h * 0xFF51AFD7ED558CCD) % 2**64 >> (64 - toxicity.BUCKET_BITS)

    def plain(text):
        words = [w.encode() for w in plain_words(text)]
        best = None
        for at in range(0, len(words), toxicity.SEGMENT):
            found = [m.grams[bucket(b[i : i + n])] for w in words[at : at + toxicity.SEGMENT] for b in [b" " + w + b" "] for n in toxicity.GRAMS for i in range(len(b) - n + 1)]
            logit = float(np.mean([float(x) for x in found])) + m.bias
            best = logit if best is None else max(best, logit)
        return 1 / (1 + math.exp(-(m.bias if best is None else best)))

    texts = [t for _, t, _ in rows[:25]] + [None, "", "a", "ß É", "x" * 700, " ".join(t for _, t, _ in rows)]
    assert np.allclose(toxicity.score_texts(texts, m.grams, m.bias), [plain(t) for t in texts], atol=1e-5)
    words = plain_words(" ".join(t for _, t, _ in rows))
    long = " ".join(words * (1 + toxicity.HELD_WORDS * 2 // len(words))) + " " + "y" * 600_000
    parts = [" ".join(plain_words(long)[k : k + toxicity.SEGMENT]) for k in range(0, len(plain_words(long)), toxicity.SEGMENT)]
    assert len(long) > 1_000_000
    assert toxicity.score_texts([long], m.grams, m.bias)[0] == pytest.approx(toxicity.score_texts(parts, m.grams, m.bias).max(), abs=1e-9)


def test_words_are_plain():
    texts = ["Don't STOP, é1!", None, "", "a", "x" * 10 + " y"]
    w = words_of(texts)
    got = [[bytes(w.buffer[a:b]).decode() for a, b in zip(w.starts[x:y], w.ends[x:y], strict=True)] for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [["don", "t", "stop", "é1"], [], [], ["a"], ["x" * 10, "y"]]
    h = words_of(["one two", "two three one"]).hashes()
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3


# The pipeline


def test_pipeline_equals_brute_force(spark, small, tmp_path):
    path = tmp_path / "sf"
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(path / f"{name}.parquet"))
    small.write.parquet(str(path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(path)).collect()
    # Stages one after the other, by plain code but for the trained scores.
    docs = [(r.doc_id, r.text) for r in small.collect()]
    model = toxicity.fit(small, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.score_texts([t for _, t in docs], model.grams, model.bias)
    docs = [d for d, s in zip(docs, scores, strict=True) if s < 0.7]
    con = duckdb.connect()
    import pandas as pd

    con.register("raw", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.execute("CREATE TEMP VIEW documents AS SELECT * FROM raw")
    docs = con.execute(f"SELECT doc_id, text FROM ({linededup.OP1_SQL})").fetchall()
    keep = {c for _, c in plain_classes(docs)}
    docs = [d for d in docs if d[0] in keep]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontam.build_index([i for i, _ in items], [t for _, t in items])
    hit = {m[0] for m in decontam.search_texts(index, [t for _, t in docs])}
    assert {k for k, (_, t) in enumerate(docs) if any(plain_contains(t, x) for _, x in items)} <= hit
    docs = [d for k, d in enumerate(docs) if k not in hit]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    want = Counter()
    for d, text in docs:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            want[d, p, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_and_survive(spark, odd, empty, k, tmp_path):
    path = tmp_path / "sf"
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(path / "benchmark.parquet"))
    labels(spark, [(6, 1, 0), (8, 1, 1)]).write.parquet(str(path / "labels.parquet"))
    _, stage = corpus_pipeline.STAGES[k]
    for docs in (odd, empty):
        out = stage(spark, docs, str(path))
        assert out.columns == docs.columns and out.count() <= docs.count()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    at = [names.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
