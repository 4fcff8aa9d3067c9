"""Quality trees, toxicity network, nearest neighbours."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann, quality, toxicity
from lodestone.llm.common import held_out

SF = "/root/testdata/sf0.1"


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def judged(spark, scored, label):
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where(held_out(F.col("doc_id"))).select("doc_id", "score", label).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    return np.array([r[label] for r in rows]), np.array([r.score for r in rows])


def odd_rows(spark):
    rows = [(1, None, 5.0), (2, "", 5.0), (None, "plain words here", 5.0), (4, "plain words here", 5.0), (4, "plain words here", 5.0), (5, "word " * 60_000, 5.0), (6, "!!! ???", 5.0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, score double")


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    y, p = judged(spark, quality.score(docs, model), "quality")
    assert auc(y, p) > 0.99 and ((p >= 0.7) == y).mean() > 0.98
    rows, df = odd_rows(spark)
    got = quality.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.text == "plain words here"}) == 1
    assert quality.score(df.limit(0), model).count() == 0
    blank = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(df, blank).collect()} == {0.5}


def test_trees_are_walked_as_grown():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)).round(1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = quality.BoostedTrees(trees=30, depth=3).fit(x, y)
    assert auc(y, m.predict(x)) > 0.97

    def walk(row):
        raw = m.base
        for root in m.roots:
            n = root
            while m.child[n] != n:
                n = m.child[n] + int(row[m.feature[n]] > m.cut[n])
            raw += m.value[n]
        return 1 / (1 + np.exp(-raw))

    assert np.allclose(m.predict(x[:50]), [walk(r) for r in x[:50]])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    network = toxicity.fit(docs, labels, 1500)
    y, p = judged(spark, toxicity.score(docs.join(labels.select("doc_id").limit(1200), "doc_id", "left_semi"), network), "toxic")
    assert auc(y, p) > 0.9
    rows, df = odd_rows(spark)
    got = toxicity.score(df, network).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.text == "plain words here"}) == 1
    assert toxicity.score(df.limit(0), network).count() == 0
    toxicity.fit(docs, labels.limit(0))


def test_toxicity_learns_from_all_windows_of_long_texts(spark):
    rng = random.Random(3)
    plain = lambda n: [rng.choice("river stone cloud paper garden window letter music bread table".split()) for _ in range(n)]
    rows = []
    for i in range(96):
        ws = plain(30 if i % 8 == 0 else 3000)
        toxic = i % 8 in (0, 1)
        if toxic:
            at = rng.randrange(len(ws) - 4)  # anywhere
            ws[at : at + 4] = "vile scum hateful filth".split()
        rows.append((i, " ".join(ws), int(toxic)))
    rows += [(1, "the same id with another text of river and stone", 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    network = toxicity.fit(df, df)
    learn = quality.labelled(df, df, "toxic", 4000)
    assert learn.where("doc_id = 1").count() == (2 if learn.where("doc_id = 1").count() else 0)
    hidden = {r[0] for r in toxicity.hardest_windows(learn, network) if b"scum" in r[3]}
    assert hidden == {r.doc_id for r in learn.where("y = 1").collect()}
    p = {(r.doc_id, len(r.text)): r.score for r in toxicity.score(df, network).collect()}
    assert min(p[i, len(t)] for i, t, y in rows[:96] if y) > 0.5 > max(p[i, len(t)] for i, t, y in rows[:96] if not y)
    used = [(r.text, r.y) for r in learn.collect()]
    again = toxicity.Network()
    again._calibrate(toxicity.Scorer(network).worst([t for t, _ in used]), np.array([float(y) for _, y in used]))
    assert abs(again.slope - network.slope) < 1e-3 and abs(again.shift - network.shift) < 1e-3
    assert quality.labelled(df, df, "toxic", 5).count() == 5  # rows are bounded, not ids


def test_lexicon_counts_all_words_of_whole_texts(spark):
    rows = [(1, "aa bb aa", 1), (3, "bb cc", 0), (5, "bb dd", 0), (6, None, 1), (7, "bb", 0)]
    df = spark.createDataFrame([(d, 0, y, t) for d, t, y in rows], "doc_id long, k long, y int, text string")
    words, grams, totals = toxicity.lexicon(df)
    assert {w: c.tolist() for w, c in words.items()} == {b"bb": [3.0, 1.0]} and totals.tolist() == [3, 2]
    exp = np.zeros((toxicity.BUCKETS, 2))
    for w, clean, toxic in ((b"aa", 0, 1), (b"bb", 3, 1), (b"cc", 1, 0), (b"dd", 1, 0)):
        for k in toxicity.ngrams([w])[0]:
            exp[k] += clean, toxic
    assert np.array_equal(grams, exp)
    assert toxicity.lexicon(df.limit(0))[0] == {}


def test_scorer_equals_one_plain_window_at_a_time(monkeypatch):
    rng = random.Random(5)
    network = toxicity.Network(seed=4)
    network.vocabulary = {b"w1": 1, b"w2": 2, b"w3": 3}
    texts = [" ".join(f"W{rng.randrange(400)}" for _ in range(n)) for n in (1, 2, 47, 48, 49, 80, 81, 333, 2000, 5)] + [None, "", "?!", "w1 " * 48]
    rng.shuffle(texts)

    def plain(text):
        ws = toxicity.tokens(text)
        if not ws:
            return network.p["base"][0]
        starts = [*range(0, len(ws) - toxicity.WINDOW, toxicity.STRIDE), len(ws) - toxicity.WINDOW] if len(ws) > toxicity.WINDOW else [0]
        worst = -np.inf
        for s in starts:
            part = ws[s : s + toxicity.WINDOW]
            worst = max(worst, float(network.forward(network.gates(part), np.arange(len(part))[None])[0][0]))
        return worst

    exp = np.array([plain(t) for t in texts])
    for remembered in (300_000, 60):
        monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
        scorer = toxicity.Scorer(network)
        assert np.allclose(scorer.worst(texts), exp, atol=1e-4)
        assert np.allclose([scorer.worst([t])[0] for t in texts], exp, atol=1e-4)


def plain_statistics(text):
    """The statistics by their definitions, character by character."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(quality.NAMES)
    share = lambda f: sum(map(f, data)) / len(data)
    sentence = b".,;:?'\"-()"
    mark = lambda c: 33 <= c < 127 and c not in sentence and not chr(c).isalnum()
    lens = [len(w) for w in words]
    mean = sum(lens) / len(lens)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        np.log1p(len(data)), np.log1p(len(words)), share(lambda c: 97 <= c <= 122), share(lambda c: 65 <= c <= 90), share(lambda c: 48 <= c <= 57), share(lambda c: c in b" \t\r"), share(lambda c: c == 10),
        share(lambda c: c in sentence), share(mark), share(lambda c: c >= 128), mean, (sum((n - mean) ** 2 for n in lens) / len(lens)) ** 0.5, np.log1p(max(lens)), len(set(words)) / len(words),
        max(words.count(w) for w in set(words)) / len(words), len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)), sum(65 <= w[0] <= 90 for w in words) / len(words), sum(mark(w[-1]) for w in words) / len(words),
        float(words[-1][-1] in sentence),
    ]


def test_statistics_against_plain_ones():
    rng = random.Random(2)
    some = ["".join(rng.choice("aB9 .,'!\n\té中_%\x0b\x00") for _ in range(rng.randrange(80))) for _ in range(200)] + [None, "", " \n", "word"]
    for t in some:
        assert np.allclose(quality.statistics(t), plain_statistics(t)), t


def test_scores_are_those_of_each_text_alone(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    for r in quality.score(docs, model).collect():
        assert r.score == pytest.approx(model.predict(np.array([plain_statistics(r.text)]))[0], abs=1e-6)


def test_gradients():
    network = toxicity.Network(seed=3)
    for k, v in network.p.items():
        network.p[k] = v.astype(np.float64)
    network.vocabulary = {b"aa": 1, b"bb": 2}
    words = [b"aa", b"bb", b"cccc", b"d"]
    at = np.array([[0, 1, 2, 3], [3, 2, -1, -1], [1, 1, 0, -1]])
    y = np.array([1.0, 0.0, 1.0])
    import unittest.mock

    with unittest.mock.patch.object(toxicity.np, "float32", np.float64):
        _, g = network.gradients(network.spelled(words), at, y)
        random.seed(1)
        for k, p in network.p.items():
            flat = p.reshape(-1)
            places = [i for i in np.flatnonzero(g[k].reshape(-1))] or [0]
            for i in random.sample(places, min(4, len(places))):
                old, e = flat[i], 1e-5
                flat[i] = old + e
                up, _ = network.gradients(network.spelled(words), at, y)
                flat[i] = old - e
                down, _ = network.gradients(network.spelled(words), at, y)
                flat[i] = old
                assert g[k].reshape(-1)[i] == pytest.approx((up - down) / (2 * e), rel=2e-2, abs=1e-5), k


def test_windows_cover_the_text():
    for n in (1, 47, 48, 49, 80, 81, 1000):
        starts = toxicity.cut(n)
        assert {i for s in starts for i in range(s, min(s + toxicity.WINDOW, n))} == set(range(n)) and starts[-1] <= max(0, n - toxicity.WINDOW)


def brute(rows, queries, k=10):
    out = []
    for q, v in queries:
        near = sorted((np.sqrt(np.cumsum((np.array(x, float) - np.array(v, float)) ** 2)[-1]), i) for i, x in rows if i != q)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=20).astype(np.float32).tolist()) for i in range(3000)] + [(5000 + i, [0.5] * 20) for i in range(400)]
    bad = [(9000, None), (9001, [0.0] * 20), (9002, [float("nan")] * 20), (9003, [1.0] * 19 + [None]), (9004, [float("inf")] * 20), (None, [1.0] * 20), (9005, [1.0] * 3)]
    df = spark.createDataFrame([(*r, 1) for r in [*rows, *bad]], "vec_id long, embedding array<float>, score int")
    monkeypatch.setattr(ann, "QUERY_ROWS", 20)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    got = sorted(tuple(r) for r in ann.search(df, df.where("vec_id % 100 = 0"), 10, 200).collect())
    exp = sorted(brute(rows, [r for r in rows if r[0] % 100 == 0]))
    assert [r[0] for r in got] == [r[0] for r in exp]
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in exp}) >= 0.95 * len(exp)
    assert [r for r in got if r[0] >= 5000] == [r for r in exp if r[0] >= 5000]  # 400 copies: the smallest ids
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id < 3")
    assert sorted(tuple(r)[:3] for r in ann.search(few, few).collect()) == [(q, r, v) for q, r, v, _ in sorted(brute(rows[:3], rows[:3]))]


def test_recall_by_table_scan_alone():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = ann.Quantizer(x[:5000].astype(float))
    ids, codes, half = np.arange(len(x)), np.asfortranarray(q.encode(x)), np.full(len(x), 0.5, np.float32)
    hits = 0
    for i in range(30):
        found = ann.best_of_block(q.tables(x[i].astype(float)), i, ids, codes, half, 200)[1]
        d = np.linalg.norm(x - x[i], axis=1)
        d[i] = np.inf
        hits += len(set(found.tolist()) & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 300


def test_plan_is_the_same_for_any_number_of_queries(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)], "vec_id long, embedding array<float>")
    import contextlib
    import io

    def lines(queries):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            ann.search(df, queries).explain()
        return len(out.getvalue().splitlines())

    with pytest.MonkeyPatch.context() as m:
        m.setattr(ann, "QUERY_ROWS", 5)
        assert lines(df.where("vec_id < 6")) == lines(df)
        got = ann.search(df, df).collect()
    assert len(got) == 6000 and len({r.query_id for r in got}) == 600
