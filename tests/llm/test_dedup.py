"""SimHash, suffix arrays, the pipeline."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import anchors, quality, simhash, suffix_dedup, suffixes


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    random.seed(1)
    words = ["a", "B", "É", "x y", "zz"]
    for n in (0, 1, 3, 4, 5, 40, 700):
        t = "".join(random.choice(words) + random.choice([" ", "\n", "\t\x0b"]) for _ in range(n))
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    assert simhash.fingerprint(None) == 0


def test_spark_hashes_alike(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c é"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest("a b c é".encode(), 42)


def test_links_are_complete(spark):
    rng = random.Random(7)
    fps = {0, (1 << 64) - 1, 1, 0b1111, 0b11111}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for b in rng.sample(range(64), rng.randrange(7)):
                x ^= 1 << b
            fps.add(x)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f, f) for f in signed], "fp long, node long")
    got = {(r.a, r.b) for r in simhash.links(df).collect()}
    exp = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert got == exp
    parts = lambda pairs: {frozenset(g) for g in grouped(signed, pairs).values()}
    for crowd in (1, 8, 30):  # crowded keys go another way, to the same components
        assert parts({(r.a, r.b) for r in simhash.links(df, crowd=crowd).collect()}) == parts(exp)
    assert parts({(r.a, r.b) for r in simhash.by_midpoints(df).collect()}) == parts(exp)


def grouped(nodes, pairs):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    out = {}
    for x in nodes:
        out.setdefault(find(x), set()).add(x)
    return out


@pytest.mark.parametrize("crowd", [4096, 3])
def test_near_duplicates_and_keeping_one(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash.links, "__defaults__", (4, crowd))
    random.seed(3)
    base = [" ".join(random.choice("abcdefghij") + str(random.randrange(50)) for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = random.choice(base).split()
        if i % 3:
            words[random.randrange(len(words))] = "new"
        rows.append((100 - i, " ".join(words)))
    rows += [(7, None), (8, ""), (9, " \n"), (None, base[0]), (None, "lonely text of no one else here"), (2**60 + 1, "another lonely text"), (41, rows[0][1]), (41, rows[0][1]), (41, rows[0][1]), (500, "long " * 200_000)]
    df = spark.createDataFrame([(d, t, "s", 1, 2, 3, 4) for d, t in rows], "doc_id long, text string, fp string, root int, id int, key int, n int")
    fps, parent = [plain_fingerprint(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    exp = Counter((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))
    got = simhash.near_duplicates(df).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()
    assert Counter(map(tuple, got)) == exp
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_induced_sorting(monkeypatch):
    rng = random.Random(5)
    for k in range(250):
        n = rng.randrange(1, 160)
        t = bytes(rng.choice(rng.choice([b"ab", b"abc", b"a", bytes(range(97, 123))])) for _ in range(n))
        t = t + t[: rng.randrange(n)] + t if k % 3 == 0 else t
        length = rng.choice([3, 8, 50, 1000])
        monkeypatch.setattr(suffixes, "BLOCK", rng.choice([1 << 20, 3]))
        blocks = list(suffixes.suffix_order(t, length, rng.choice([1 << 24, 2, 8]), rng.choice([1 << 26, 50])))
        pos, shared = [int(x) for p, _ in blocks for x in p], [int(x) for _, s in blocks for x in s]
        assert sorted(pos) == list(range(len(t)))
        for a, b, s in zip(pos, pos[1:], shared[1:], strict=False):
            common = next((i for i in range(length) if t[a + i : a + i + 1] != t[b + i : b + i + 1] or not t[a + i : a + i + 1]), length)
            assert t[a : a + length] <= t[b : b + length] and s == common


def test_segments_cover_all_windows():
    rng = np.random.default_rng(3)
    for n in (0, 199, 200, 201, 5000):
        for data in (rng.integers(97, 100, n).astype(np.uint8), np.full(n, 97, np.uint8)):
            first, count, at, _ = anchors.segments(data)
            assert sum(count) == max(0, n - 199) and (first + count == np.append(first[1:], max(0, n - 199)) if len(first) else np.ones(1, bool)).all()
            assert all(f <= a or True for f, a in zip(first, at, strict=True))


def removed(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mark, strict=True) if not m)
        out.append((len(b), sum(mark), sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1])), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("crowd", [256, 1])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "CROWDED_ROWS", 1_000 if crowd > 1 else 0)
    random.seed(11)
    letters = "abcdé \n"
    make = lambda n: "".join(random.choice(letters) for _ in range(n))
    passages = [make(random.randrange(150, 700)) for _ in range(8)] + ["line of text. " * 40, "a" * 900, "ab" * 450]
    texts = []
    for _ in range(50):
        texts.append("".join(make(random.randrange(300)) + random.choice(passages) for _ in range(random.randrange(1, 5))))
    texts += [texts[0], texts[1], None, "", "short", make(199), passages[0], passages[0][1:], "x" * 200, "\x00" + passages[2]]
    near = texts[3]
    for _ in range(20):
        i = random.randrange(len(near))
        texts.append(near[:i] + "!" + near[i + 1 :])
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, passages[3]), (0, texts[0]), (0, texts[0])]
    df = spark.createDataFrame([(d, t, 1, "y", 2, 3, 4) for d, t in rows], "doc_id long, text string, spans int, k string, id int, __id int, key int")
    exp = Counter((d, *e[:4]) for (d, _), e in zip(rows, removed([t for _, t in rows]), strict=True))
    assert Counter(map(tuple, suffix_dedup.digests(df).collect())) == exp
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "k", "id", "__id", "key", "spans"] and out.where("id = 2 AND __id = 3 AND key = 4").count() == len(rows)
    whole = Counter((d, None if t is None else e[4].decode("utf-8", "replace")) for (d, t), e in zip(rows, removed([t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == whole
    assert suffix_dedup.digests(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        path = corpus_pipeline.workspace(spark) + f"/stage-{i}"
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        if i < 4:
            assert out.columns == docs.columns, name
            after = {r.doc_id: r.text for r in out.collect()}
            assert set(after) <= set(before) and len(after) == out.count()
        if i == 1:
            fps = {d: plain_fingerprint(t) for d, t in after.items()}
            ids = sorted(fps)
            assert all((fps[a] ^ fps[b]).bit_count() > 4 for k, a in enumerate(ids) for b in ids[k + 1 :])
        if i == 2:
            ids = sorted(before)
            exp = {d: e[4].decode("utf-8", "replace") for d, e in zip(ids, removed([before[d] for d in ids]), strict=True)}
            assert after == exp and all(r.n_chars == len(r.text) for r in out.collect())
        docs = out
    assert docs.where("length > 1024").count() == 0 and docs.select("doc_id").distinct().count() == len(after)
    assert quality is not None and corpus_pipeline.run(spark, sf).count() == docs.count()


def test_names_of_a_string_far_larger_than_memory(monkeypatch, tmp_path):
    rng = np.random.default_rng(8)
    text = rng.choice(np.frombuffer(b"abcd", np.uint8), 400_000)
    (tmp_path / "text").write_bytes(text.tobytes() + b"\0")
    whole = suffixes.Sorter(np.memmap(tmp_path / "text", np.uint8, "r"), 200, tmp_path)
    at = np.array(whole.stars())
    rank, many = whole.names(at)
    rank = np.array(rank)
    monkeypatch.setattr(suffixes, "BLOCK", 1 << 11)
    small = suffixes.Sorter(np.memmap(tmp_path / "text", np.uint8, "r"), 200, tmp_path, base=1 << 10, depth=1)
    tracemalloc.start()
    places = small.stars()
    names, n = small.names(places)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == many and (places == at).all() and (names == rank).all()
    assert peak < 8 * len(at), peak  # the positions alone would take as much


def test_recursion_on_disk(monkeypatch, tmp_path):
    text = np.append(np.random.default_rng(9).choice(np.frombuffer(b"abcd", np.uint8), 40_000), np.uint8(0))
    text[30_000:30_500] = text[100:600]
    monkeypatch.setattr(suffixes, "BLOCK", 1 << 10)
    flags = suffixes.repeated(text, 200, tmp_path, base=1 << 10, queue_bytes=1 << 12)
    often = Counter(grams := [text[i : i + 200].tobytes() for i in range(len(text) - 199)])
    assert np.flatnonzero(flags).tolist() == [i for i, g in enumerate(grams) if often[g] > 1] != []
    assert (tmp_path / "names2").exists()  # names of names of names


def test_sorters_give_their_room_back(tmp_path):
    """Once the order is being read, no file of what led to it has a name: its room is free as soon as it isn't mapped."""
    text = np.append(np.random.default_rng(3).integers(1, 5, 60_000).astype(np.uint8), np.uint8(0))
    (tmp_path / "text").write_bytes(text.tobytes())
    sorter = suffixes.Sorter(np.memmap(tmp_path / "text", np.uint8, "r"), 200, tmp_path, base=1 << 10, queue_bytes=1 << 12)
    found = [(pos.copy(), sum(f.stat().st_size for f in tmp_path.iterdir())) for pos, _ in sorter.suffixes()]
    assert sorted(np.concatenate([pos for pos, _ in found]).tolist()) == list(range(len(text)))
    assert max(size for _, size in found) <= 2 * len(text)
