"""Tokens, wavelet shards, packing."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import packing, tokens, wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = "a bé1²½_'s\n\t  .,!\x1c\x85\xa0中ⅷ́👍"


def texts(n, seed=1):
    random.seed(seed)
    some = ["".join(random.choice(ODD) for _ in range(random.randrange(60))) for _ in range(n)]
    return some + [None, "", " ", "\n", "a" * 5000, "<|endoftext|> 'll", "word " * 900, "  x  "]


def plain_ids(text, lib=Tokenizer.from_file(PATH)):
    """What the library gives, used as it comes."""
    return lib.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(monkeypatch):
    enc = tokens.TextEncoder(PATH)
    assert enc.simple
    assert 50256 in plain_ids("hello <|endoftext|> x") and 50256 not in next(tokens.TextEncoder(PATH, plain=True).encode(["hello <|endoftext|> x"]))
    for at_once, kept in ((10**6, 10**6), (50, 20)):
        monkeypatch.setattr(tokens, "AT_ONCE", at_once)
        monkeypatch.setattr(tokens, "REMEMBERED", kept)
        for seed in range(3):
            some = texts(150, seed)
            for t, ids in zip(some, enc.encode(some), strict=True):
                assert ids.tolist() == plain_ids(t), t


def test_wavelet_matrix(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(wavelet, "SAMPLE", 100)
    monkeypatch.setattr(wavelet, "BLOCK", 1024)
    for n in (0, 1, 7, 512, 513, 1024, 5000):
        ids = np.minimum(rng.zipf(1.3, n), 60_000).astype(np.uint16)
        f = wavelet.ShardFile(wavelet.pack_file([1, None], np.array([n, 0]), ids, 16))
        assert np.array_equal(f.decode(np.uint16), ids) and f.doc_ids == [1, None] and f.lengths.tolist() == [n, 0]
        for i in range(0, n, 97):
            assert f.access(i) == ids[i]
            assert f.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
        for t in {*ids[:5].tolist(), 0, 1, 59_999, 65_535, 70_000}:
            assert f.count(t) == (ids == t).sum() and f.locate(t) == np.flatnonzero(ids == t).tolist()
        with pytest.raises(IndexError):
            f.access(n)
        with pytest.raises(IndexError):
            f.select(1, int((ids == 1).sum()))


def test_lookups_read_only_the_blocks_they_touch():
    ids = np.random.default_rng(1).integers(0, 50_000, 1_000_000).astype(np.uint16)
    data = wavelet.pack_file([1], np.array([len(ids)]), ids, 16)
    f = wavelet.ShardFile(data)
    assert f.access(777_777) == ids[777_777] and f.read <= 16
    f = wavelet.ShardFile(data)
    token = int(ids[5])
    places = np.flatnonzero(ids == token)
    assert f.select(token, 3) == places[3] and f.read <= 48
    assert f.locate(token) == places.tolist()


def test_tokens_are_found_in_the_files(spark):
    rows, df = table(spark, texts(40))
    rows, df = [r for r in rows if r[1] != "again"], df.where("text IS NULL OR text != 'again'")  # rows of one id come in the order of their hashes
    shards = wavelet.stored(wavelet.write_shards(df, PATH, 0, 1000, 100), "t")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in order] == [r.doc_id for r in wavelet.read_shards(shards).orderBy("start").collect()]
    every = [i for _, t, _ in order for i in [*plain_ids(t), 0]]
    for t, n in wavelet.counts(shards, [0, 64, 50_000]).collect():
        assert n == every.count(t)
    assert sorted(r.place for r in wavelet.occurrences(shards, [0]).collect()) == [i for i, x in enumerate(every) if x == 0]


def table(spark, some):
    rows = [(len(some) - i, t, "x") for i, t in enumerate(some)] + [(None, "no id", "x"), (2**60 + 1, "long id", "x"), (3, "again", "x"), (3, "again", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_shards_round_trip(spark):
    rows, df = table(spark, texts(60))
    for shard_tokens in (1 << 20, 100):
        got = [tuple(r) for r in wavelet.read_shards(wavelet.stored(wavelet.write_shards(df, PATH, 0, 1000, shard_tokens), "t")).collect()]
        assert len(got) == len(rows)
        got.sort(key=lambda r: r[1])
        assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
        assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()[:-1]]
        crc = lambda t: zlib.crc32(np.array([*plain_ids(t), 0], "<u4").tobytes())
        assert Counter((r[0], r[3]) for r in got) == Counter((d, crc(t)) for d, t, _ in rows)
    assert wavelet.read_shards(wavelet.save(df.limit(0), PATH)).count() == 0


def test_pieces_and_packing(spark):
    rows, df = table(spark, texts(60))
    packed = packing.pack(packing.cut(df, PATH, 64), 64)
    got = packed.collect()
    exp = Counter()
    for d, t, _ in rows:
        ids = np.array([*plain_ids(t), 2], "<u4")
        first = len(ids) % 64 or 64
        cuts = [0, len(ids)] if len(ids) <= 64 else [0, *range(first, len(ids) + 1, 64)]
        exp.update((d, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == exp
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 64
    total = sum(r.length for r in got)
    assert len(bins) <= 1.1 * -(-total // 64)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * total and len(whole) == len(bins)
    assert packing.pack(packing.cut(df.limit(0), PATH)).count() == 0
    assert F is not None


def test_local_search_empties_bins():
    for seed in range(6):
        rng = np.random.default_rng(seed)
        histogram = Counter(rng.integers(1, 101, 300).tolist())
        bins = packing.Bins(100)
        bins.best_fit(histogram)
        before, squares = sum(bins.count.values()), sum(sum(x) ** 2 * n for x, n in bins.count.items())
        bins.search()
        assert sum(bins.count.values()) <= before and sum(sum(x) ** 2 * n for x, n in bins.count.items()) >= squares
        got = Counter()
        for x, n in bins.count.items():
            assert sum(x) <= 100
            for y in x:
                got[y] += n
        assert got == histogram
    bins = packing.Bins(10)
    bins.count.update({(6, 2): 1, (4, 3): 1, (5,): 1})  # 20 in three bins; a move and a swap make two full ones
    bins.search()
    assert sum(bins.count.values()) == 2


def rises(bins):
    """A step of the neighbourhood that still raises the squares, by looking at all pairs of bins."""
    for a in bins.count:
        for b in bins.count:
            if sum(a) > sum(b) or (a == b and bins.count[a] < 2):
                continue
            room = bins.capacity - sum(b)
            gives = [(x,) for x in set(a)]
            twos = lambda p: {(x, y) for i, x in enumerate(p) for y in p[i + 1 :]}
            steps = [(x, y) for x in gives for y in [(), *[(y,) for y in set(b)], *twos(b)]] + [(x, (y,)) for x in twos(a) for y in set(b)]
            for x, y in steps:
                if 0 < sum(x) - sum(y) <= room:
                    return a, b, x, y
    return None


def test_local_search_ends_where_no_step_is_left():
    for seed in range(25):
        rng = np.random.default_rng(seed)
        capacity = int(rng.integers(10, 60))
        histogram = Counter(rng.integers(1, capacity + 1, int(rng.integers(1, 80))).tolist())
        bins = packing.Bins(capacity)
        bins.best_fit(histogram)
        bins.search()
        total = sum(k * n for k, n in histogram.items())
        assert sum(bins.count.values()) == -(-total // capacity) or rises(bins) is None


@pytest.mark.parametrize("n", [100_000, 10_000_000])
def test_local_search_lowers_bins_at_any_size(n):
    lengths = np.clip(np.random.default_rng(1).lognormal(5.5, 0.9, n).astype(int), 1, 1024)
    kinds, counts = np.unique(lengths, return_counts=True)
    histogram = dict(zip(kinds.tolist(), counts.tolist(), strict=True))
    bins = packing.Bins(1024)
    bins.best_fit(histogram)
    before, bound = sum(bins.count.values()), -(-int(lengths.sum()) // 1024)
    bins.search()
    after = sum(bins.count.values())
    assert after < before and after - bound < 0.35 * (before - bound)
    got = Counter()
    for items, k in bins.count.items():
        assert sum(items) <= 1024
        for x in items:
            got[x] += k
    assert got == histogram
    if after > bound:  # no step is left: none of the open patterns' looks finds one
        assert all(bins.step(b) is None for b in bins.count if sum(b) < 1024)


def test_packing_keeps_columns_of_any_name(spark):
    rows, df = table(spark, texts(20))
    pieces = packing.cut(df, PATH, 64).withColumns({c: F.lit(7) for c in ("first", "firsts", "rank", "to", "n", "at", "_to", "offset", "sequence_id", "block")})
    for shards in (4096, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(packing, "BROADCAST_SHARDS", shards)
            got = packing.pack(pieces, 64)
            assert {"first", "firsts", "rank", "to", "n", "at", "_to", "block"} <= set(got.columns) and got.where("first = 7 AND rank = 7 AND n = 7").count() == pieces.count()
            ends = got.groupBy("sequence_id").agg(F.max(F.col("offset") + F.col("length")).alias("e"), F.sum("length").alias("s")).where("e != s OR e > 64")
            assert ends.count() == 0
