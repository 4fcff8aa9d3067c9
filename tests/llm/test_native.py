"""URL filters, chat formatting, decontamination."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.llm import chat_format, decontaminate, queries, url_filter

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, found = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(repr([r[c] for c in names]) for r in df.select(*names).collect()) == sorted(map(repr, map(list, found.fetchall())))


def test_urls(spark):
    urls = ["http://a.example.com/en/71?x", "HTTP://WWW.B.org/es/#f", "b.com/en/", None, "x://casino-win.info", "x://onlinecasino.de?q", "x://citynews.de/", "://example.net/de/8", "s://net/de/?", "s://Xexample.com/en/7", "s://é.com/en/1", ""]
    pages = spark.createDataFrame([(i, u, None, 1) for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, html string, score int")
    got = {r.page_id: r for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    assert len(got) == 13
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.com", "/en/71", "example.com/en/7", "allow") and got[12].verdict == "allow"
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.b.org", "/es/", "org/es/", "block")
    assert [(got[i].host, got[i].path, got[i].rule) for i in (2, 3, 11)] == [("", "", None)] * 3
    assert [got[i].verdict for i in (4, 5, 6)] == ["block", "block", "allow"] and got[5].rule is None
    assert (got[7].rule, got[8].rule) == ("example.net/de/8", "net/de/") and got[9].rule == "com/en/"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge(empty, queries.URL_RULES).count() == 0


def test_segmenter_finds_the_best_split():
    cut = url_filter.Segmenter({"online": 9e-3, "casino": 5e-3, "on": 5e-3, "line": 4e-3, "win": 3e-3})
    assert cut.split("onlinecasino") == ["online", "casino"] and cut.split("zzcasinoqq") == ["zz", "casino", "qq"] and cut.split("") == []
    random.seed(2)
    words = {"ab": 4e-2, "abc": 2e-3, "c": 9e-2, "ca": 1e-4}
    cut = url_filter.Segmenter(words)

    def cost(parts):
        return sum(cut.cost[p] if p in cut.cost else -math.log(url_filter.UNKNOWN) + len(p) * math.log(10) for p in parts)

    def every(s):
        if not s:
            yield []
        for i in range(1, len(s) + 1):
            for rest in every(s[i:]):
                yield [s[:i], *rest]

    for _ in range(40):
        name = "".join(random.choice("abcz") for _ in range(random.randrange(1, 8)))
        assert cost(cut.split(name)) == pytest.approx(min(map(cost, every(name))))


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|>\n<|user|>\n", "\\l\\e\\\\g", None, "", "<|+|>", "é😀", "a" * 50_000]
    random.seed(3)
    rows = [(c, t if random.random() < 0.9 else None, random.choice(["user", "assistant", "system", None, "<|odd|>\n"]), random.choice(texts), 7) for c in (1, 2, 3, None) for t in range(30)] + [(9, 0, "user", "same", 1)] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    assert set(got) == {1, 2, 3, None, 9}
    for c, r in got.items():
        mine = sorted(((t is not None, t or 0, role or "", x or "") for k, t, role, x, _ in rows if k == c))
        assert [(x.role, x.text) for x in r.turns] == [(role, x) for _, _, role, x in mine]
        assert r.loss_text == "".join(x for _, _, role, x in mine if role == "assistant")
        runs = sum(1 for i, m in enumerate(mine) if i == 0 or mine[i - 1][2] != m[2])
        assert len(r.loss_mask) == runs == r.formatted.count(chat_format.END)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def contaminated(docs, bench, n=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    wins = [(i, tuple(w[k : k + min(len(w), n)])) for i, t in bench for w in [cut(t)] for k in range(len(w) - min(len(w), n) + 1) if w]
    for d, t in docs:
        w = cut(t)
        hit, items = set(), set()
        for i, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    items.add(str(i))
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark):
    random.seed(5)
    words = ["a", "B", "É", "é", "k2", "zz"]
    make = lambda n: random.choice([" ", ", ", "-"]).join(random.choice(words) for _ in range(n))
    bench = [(i, make(random.choice([0, 1, 5, 12, 13, 14, 30]))) for i in range(9)] + [(10, None), (11, "only"), (12, "K unit x")]
    bench.append((20, bench[3][1]))
    docs = [(i, make(40) + " " + (random.choice(bench)[1] or "") + " " + make(3)) for i in range(40)] + [(100, None), (101, ""), (102, "..."), (103, "the ONLY one"), (104, "a " * 3000 + "k unit X"), (5, "twice only"), (None, "only")]
    docs += [docs[0], docs[-1]]
    d = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in docs], "doc_id long, text string, items string, id int, key int, hits int, __id int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    key = lambda r: (r[0] is None, *map(str, r))
    got = sorted((tuple(r) for r in decontaminate.digest(decontaminate.contamination(d, b)).collect()), key=key)
    exp = sorted(contaminated(docs, bench), key=key)
    assert got == exp
    clean = sorted(((i, t) for (i, t), e in zip(docs, contaminated(docs, bench), strict=True) if not e[5]), key=key)
    assert sorted(((r.doc_id, r.text) for r in decontaminate.remove_documents(d, b).collect()), key=key) == clean
    cut = decontaminate.remove_spans(d, b).where("doc_id = 103").first()
    assert cut.text == "the  one" and cut.items == "x"
    assert decontaminate.remove_spans(d, b).columns == d.columns == decontaminate.remove_documents(d, b).columns
    assert {(cut.id, cut.key, cut.hits, cut["__id"])} == {(1, 2, 3, 4)} == {tuple(r)[3:] for r in decontaminate.remove_documents(d, b).collect()}
    nameless = decontaminate.contamination(d, spark.createDataFrame([(None, "the only one")], b.schema)).where("doc_id = 103").first()
    assert (nameless.n_hit, nameless.n_items, nameless.items) == (3, 0, [])
    assert decontaminate.contamination(d, b.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(d.limit(0), b).count() == 0


def test_large_benchmarks_need_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, bench = [(1, "x " * 20 + "a b c d e f g h i j k l m n"), (2, "a b c")], [(1, "a b c d e f g h i j k l m n"), (2, "zz")]
    got = decontaminate.digest(decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")))
    assert sorted(tuple(r) for r in got.collect()) == sorted(contaminated(docs, bench))
    assert F is not None


def test_contamination_with_capital_sigmas(spark):
    text = " ".join(f"\u0391{i}.\u03a3" for i in range(13))
    docs = spark.createDataFrame([(1, text), (2, "other words here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.contamination(docs, items).collect()} == {1: True, 2: False}


def judged_plainly(rows, rules):
    """The whole judgement over (url, html) rows in plain Python."""
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    seeds = [Counter(w for n in names for w in n.split()) for names in (url_filter.BLOCK_NAMES, url_filter.ALLOW_NAMES)]
    corpus = Counter(w for _, h in rows for w in re.findall("[a-z0-9]+", lower(re.sub(r"(?is)<(script|style)\\b.*?</\\1\\s*>|<[^>]*>", " ", h or ""))))
    total, both = sum(corpus.values()), seeds[0] + seeds[1]
    share = {w: 0.95 * corpus[w] / max(total, 1) + 0.05 * both[w] / sum(both.values()) for w in set(corpus) | set(both)}
    seen = {}
    for url in {u or "" for u, _ in rows}:
        host = path = ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
            host = lower(host)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, ruled = max(fits)[1:] if fits else (None, None)
        labels = host.split(".")
        labels = [x for x in (labels[:-1] if len(labels) > 1 else labels) if x not in url_filter.ENDINGS]
        names = [w for x in labels for w in re.findall("[a-z0-9]+", x)] + [w for w in re.findall("[a-z0-9]+", lower(path)) if not w.isdigit()]
        words = []
        for n in names:
            inside = {n[i:j] for i in range(len(n)) for j in range(i + 1, min(len(n), i + 24) + 1)}
            inside |= {w for w in share if len(w) > 24 and w in n}
            words += url_filter.Segmenter({w: share[w] for w in inside if w in share}).split(n)
        seen[url] = host, path, rule, ruled, words
    by = {v: Counter(w for x in seen.values() if x[3] == v for w in x[4]) for v in ("block", "allow")}
    sizes = {v: max(1, sum(c.values())) for v, c in by.items()}
    docs = {v: sum(x[3] == v and bool(x[4]) for x in seen.values()) for v in by}
    smooth = lambda c: sum(c.values()) + len(both) + 1
    odds = {w: math.log(by["block"][w] / sizes["block"] + (1 + seeds[0][w]) / smooth(seeds[0])) - math.log(by["allow"][w] / sizes["allow"] + (1 + seeds[1][w]) / smooth(seeds[1])) for w in {*both, *by["block"], *by["allow"]}}
    q = len(url_filter.BLOCK_NAMES) / (len(url_filter.BLOCK_NAMES) + len(url_filter.ALLOW_NAMES))
    block = (docs["block"] / sum(docs.values()) + q) / 2 if sum(docs.values()) else q
    out = {}
    for url, (host, path, rule, ruled, words) in seen.items():
        score = math.log(block / (1 - block)) + sum(odds.get(w, 0) for w in words)
        out[url] = host, path, rule, ruled or ("block" if score > 0 else "allow"), score
    return out


def test_urls_against_plain_judgement(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").union(spark.read.parquet(f"{SF}/pages.parquet"))
    odd = [(-1, None, "<p>x"), (-2, "http://freebetscasino.xyz/a/" + "verylong" * 500, None), (-3, "x", ""), (-4, "http://öl.de/ÄB%20c", "<script>no</script>yes"), (-4, "http://öl.de/ÄB%20c", "a"), (-5, "http://poker" + "longwordofmanyletters" * 2 + "site.info/", "longwordofmanyletterslongwordofmanyletters longwordofmanyletterslongwordofmanylettersx")]
    pages = pages.union(spark.createDataFrame(odd, pages.schema)).withColumns({"key": F.lit(1), "n": F.lit(2), "w": F.lit("x"), "name": F.lit(3)})
    rows = [(r.url, r.html) for r in pages.collect()]
    exp = judged_plainly(rows, queries.URL_RULES)
    got = url_filter.judge(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows) and {r.verdict for r in got} == {"allow", "block"}
    for r in got:
        e = exp[r.url or ""]
        assert (r.host, r.path, r.rule, r.verdict) == e[:4] and r.score == pytest.approx(e[4], abs=1e-6), r.url
    assert next(r for r in got if r.page_id == -2).verdict == "block"
    # What is said doesn't depend on how often the table holds its rows.
    many = pages
    for _ in range(4):
        many = many.union(many)
    again = {r.url: (r.verdict, r.score) for r in url_filter.judge(many, queries.URL_RULES).distinct().collect()}
    for r in got:
        assert again[r.url][0] == r.verdict and again[r.url][1] == pytest.approx(r.score, abs=1e-6)


def test_very_long_urls_end(spark):
    """A path of a hundred thousand letters and one of twenty thousand words, beside a word of many letters."""
    random.seed(6)
    letters, word = "".join(random.choice("abcdefgh") for _ in range(100_000)), "extraordinarilylongcompoundwordofletters"
    rows = [(1, f"http://a.info/{letters}", f"<p>{word} cafe bad hedge"), (2, "http://b.info/" + "/".join(random.choice(["cafe", "casino", "hedge"]) for _ in range(20_000)), None), (3, f"http://my{word}casino.info", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    want = judged_plainly([r[1:] for r in rows], queries.URL_RULES)
    for i, url, _ in rows:
        assert (got[i].verdict, got[i].path) == (want[url][3], want[url][1]) and got[i].score == pytest.approx(want[url][4], rel=1e-7, abs=1e-6)
    names = spark.createDataFrame([(f"my{word}casino",)], "name string")
    split = url_filter.segment(names, url_filter.word_shares(pages, "html")).first().words
    assert split == ["my", word, "casino"]
