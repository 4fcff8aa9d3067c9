"""Importance resampling, whitening, main texts of pages."""

import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest

from lodestone.llm import html_text, importance, queries, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text):
    ws = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(ws), [zlib.crc32(" ".join(ws[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def test_features_of_texts_are_those_of_plain_code():
    random.seed(4)
    texts = ["", "a", "A b", "é Éa  b7c_x", "x" * 70_000 + " " + "y" * 49 + " z", *["".join(random.choice("aAbZ09 .-é漢\n") for _ in range(random.randrange(200))) for _ in range(60)]]
    words, owner, bucket = importance.features([t.encode() for t in texts])
    for i, t in enumerate(texts):
        n, want = _features(t)
        assert words[i] == n and sorted(bucket[owner == i].tolist()) == sorted(want)


def _resampled(docs, target, percent=5):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for b in _features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[i] + 1) * (sum(s) + 10_000) / ((s[i] + 1) * (sum(t) + 10_000)))) for i in range(10_000)]
    rows = []
    for d, text in docs:
        n, f = _features(text)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def test_importance_resampling_of_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_importance_resampling"](spark, SF)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_resampled(docs, target), key=repr)


def test_importance_resampling_of_odd_rows(spark):
    random.seed(7)
    text = lambda n: " ".join(random.choice(["one", "two", "Three", "fö"]) for _ in range(n))
    docs = [(i, text(random.randrange(60))) for i in range(80)] + [(None, text(30)), (90, None), (91, ""), (92, "  "), (2**53 + 1, text(40)), (93, text(40_000))]
    docs += [(7, "same words " * 12)] * 40 + [(8, "same words " * 12)] * 3
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, rank int, n_features string").repartition(5)
    none = spark.createDataFrame([], "item_id long, text string")
    for target, some in ((none, []), (spark.createDataFrame([(1, "one fö two"), (2, None)], "item_id long, text string"), ["one fö two", None])):
        got = [tuple(r) for r in importance.resample(df, target, 30).collect()]
        assert sorted(got, key=repr) == sorted(_resampled(docs, some, 30), key=repr)
    drawn = importance.drawn_documents(df, none, 30).collect()
    assert sorted(r["rank"] for r in drawn) == list(range(1, len(drawn) + 1)) and {r.text for r in drawn} <= {t for _, t in docs}
    assert sorted((r.doc_id, r["rank"]) for r in drawn if r.doc_id is not None) == sorted((r[0], r[4]) for r in _resampled(docs, [], 30) if r[4] and r[0] is not None)
    assert importance.resample(df.limit(0), none).count() == 0


def _whitened(vectors, wanted=4):
    """(n, sums, eigenvalues, directions, trace) by the whole covariance."""
    x = np.array(sorted({tuple(math.floor(256 * float(c)) for c in v) for v in vectors}))
    n, c = len(x), x - x.mean(0)
    e, u = np.linalg.eigh(c.T @ c / n)
    return n, x.sum(0), e[::-1][:wanted], u[:, ::-1][:, :wanted], e.sum()


def test_whitening_of_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, sums, e, u, trace = _whitened([r.embedding for r in rows])
    got = queries.QUERIES["op12_whitening"](spark, SF).collect()
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    by = {(r.vec_id, r.component): r for r in got}
    first = by[rows[0].vec_id, 1]
    for k in range(4):
        sign = None
        for r in rows:
            x = np.array([math.floor(256 * float(c)) for c in r.embedding])
            want, g = float((x - sums / n) @ u[:, k] / math.sqrt(e[k])), by[r.vec_id, k + 1]
            sign = sign or (1 if want * g.whitened > 0 else -1)
            assert g.whitened == pytest.approx(sign * want, abs=1e-9)
            assert g.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
            assert g.explained == pytest.approx(e[k] / trace, rel=1e-9)
    assert first.component == 1 and type(first.deviation) is int


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=6)]) for i in range(30)]
    rows += rows[:10] + [(None, rows[0][1])] + [(100, rows[3][1])] * 50 + [(2**53 + 1, rows[4][1])]
    odd = [(200, None), (201, [1.0, None] + [0.0] * 4), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, [1.0, 2.0]), (205, [])]
    schema = "vec_id long, embedding array<float>, n int, component string"
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], schema).repartition(4)
    got = whitening.whiten(df).collect()
    n, _, e, _, trace = _whitened([v for _, v in rows])
    assert n == 30 and {r.n for r in got} == {30} and len(got) == 4 * len(rows) and {r.vec_id for r in got} == {i for i, _ in rows}
    assert sorted({(r.component, round(r.explained, 9)) for r in got}) == [(k + 1, round(e[k] / trace, 9)) for k in range(4)]
    few = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(few).collect()  # two distinct vectors: one component
    assert [r.component for r in got] == [1] * 3 and {r.n for r in got} == {2} and got[0].explained == pytest.approx(1) and {round(abs(r.whitened), 9) for r in got} == {1.0}
    assert whitening.whiten(few.limit(2)).count() == 0 and whitening.whiten(few.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.5]), (3, [0.0, 9e15])], "vec_id long, embedding array<double>")
    got = whitening.whiten(huge).collect()
    assert {r.deviation for r in got} == {None} and {r.n for r in got} == {3}


def test_lanczos_restarts_where_a_block_breaks_down():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for spectrum in ([5, 5, 5, 5, 5, 5, *[0] * 34], [9, 1, *[1e-3] * 38], list(range(40, 0, -1)), [1] * 40, [3, 2, 1, *[0] * 37]):
        a = q @ np.diag(np.array(spectrum, float)) @ q.T
        calls = []
        e, u = whitening.largest_components(lambda v, a=a, calls=calls: calls.append(v.shape[1]) or a @ v, 40, 4)
        assert e == pytest.approx(sorted(spectrum, reverse=True)[:4], abs=1e-10) and u.T @ u == pytest.approx(np.eye(4), abs=1e-10)
        assert np.abs(a @ u - u * e).max() < 1e-10 and sum(calls) <= 40


def _article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_main_texts_of_a_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op13_main_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, _article(pages[r.page_id].html), len(r.text))


LAYOUTS = [
    (
        '<html><body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div><div id="wrap"><nav>x</nav><div class="col-main"><h1>Title {i}</h1><p>{t}<p>Two &amp; three<br>four</p><form>f</form>'
        '<div class="share-buttons"><a href=x>Share</a></div></div><div class="sidebar"><p>side</p></div><div id="comments"><p>Nice post! I like it very much indeed and so on and on and on and on and on.</p></div></div><footer>f</footer>',
        "Title {i}\n{t}\nTwo & three four",
    ),
    (
        '<main><article class="post has-comments" id=p{i}><header><h1>H &lt;{i}&gt;</h1></header><section><p>{t}</p><script>var x = "<p>no</p>";</script></section><section><p>d <i>e</i>&nbsp;f</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></section>'
        '<aside>no</aside><footer>tags</footer></article><article class="comment"><p>hey</p></article></main><!-- <p>gone</p> -->',
        "H <{i}>\n{t}\nd e f\nx\ny\n1\n2",
    ),
    ('<body><div class="content-with-ads"><h2>T</h2><p title="a > b">{t}</p><div class=ad>buy</div><p>more</p></div><div class="post-comments">c c c</div><div class="Newsletter-SignUp">mail us</div>', "T\n{t}\nmore"),
]


@pytest.mark.parametrize("layout", range(len(LAYOUTS)))
def test_main_text_of_other_layouts(layout):
    page, want = LAYOUTS[layout]
    for i, t in ((1, "A text that is long enough to be one."), (20, "Short.")):
        assert html_text.main_text(page.replace("{i}", str(i)).replace("{t}", t), None) == want.replace("{i}", str(i)).replace("{t}", t)


def test_hosts_agree_on_where_the_text_is(spark):
    t = "Long paragraphs tell a story, and this one goes on for quite a while. "
    usual = lambda body, note: f'<div class="a1"><p>{note}</p></div><div class="b{len(body) % 9}"><h1>T</h1><p>{body}</p></div><div class="c"><a href="/">all</a> <a href="/2">more</a></div>'
    rows = [(i, f"http://one.org/{i}", usual(t * 9, "Note.")) for i in range(12)]
    rows += [(50, "http://one.org/short", usual("Hi.", "A notice that is much longer than what the page says. " * 9))]  # alone it would vote for the notice
    rows += [(60 + i, f"http://two.org/{i}", f'<div class="x"><p>{t * 3}</p></div>') for i in range(3)] + [(70, "http://two.org/q", f"<section><p>{t}</p></section>")]
    rows += [(80, None, f"<p>{t}"), (81, "nothing", ""), (82, "http://e.org", None), (83, "http://e.org", "<nav>n</nav>"), (84, "http://f.org", "plain  text\n&amp; more"), (84, "http://f.org", "plain  text\n&amp; more")]
    rows += [(85, "http://g.org", f"<article>{'<p>' + t.strip() + '</p>'}</article>" * 1), (86, "http://g.org", "<article>" + "<p>x y z</p><div><b>" * 20_000 + "</article>")]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "page_id long, url string, html string, winners string, host int").repartition(3)
    found = html_text.extract(df)
    assert found.columns == ["page_id", "url", "html", "winners", "host", "text"] and found.count() == len(rows)
    got = {r.page_id: r.text for r in found.collect()}
    assert got[0] == "T\n" + (t * 9).strip() and got[50] == "T\nHi." and got[60] == (t * 3).strip() and got[70] == got[80] == t.strip()
    assert (got[81], got[82], got[83], got[84]) == ("", "", "", "plain text & more") and got[86] == "\n".join(["x y z"] * 20_000)
    assert {r.winners for r in found.collect()} == {"own"} and html_text.extract(df.limit(0)).count() == 0
    again = html_text.extract(df.withColumn("text", df["url"]))
    assert again.columns == ["page_id", "url", "html", "winners", "host", "text"] and sorted(map(repr, again.collect())) == sorted(map(repr, found.collect()))
