"""URL filters: rules first, then words of host and path scored by naive Bayes.

Names in hosts are often words run together. A unigram model splits them: Viterbi finds the split with the highest
product of word probabilities. The model is that of all words of the whole page table. Each distinct name looks up, by a
join, the words that stand in it, so the dictionary grows with the table and is never in one place. The words then go to
a multinomial naive Bayes model, which is learnt from the urls that the rules have judged, with a list of labelled example
names as a prior.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, heavy_keys, spread_join, stored

#: Letters up to which every piece of a name is looked up (longer words are, by their first so many letters); weight of an unknown word before its letters; share of the example names' words in the unigram model.
PIECE, UNKNOWN, SEEDED = 24, 0.01, 0.05
#: Pieces of names that go to Spark at once.
PIECES = 200_000
#: Example names, each with its words written apart.
BLOCK_NAMES = (
    "casino win", "online casino", "free bets", "sports bet", "poker room", "slots jackpot", "adult x", "adult video", "sex cams", "porn tube", "xxx movies", "hot escort", "cheap pills", "viagra shop",
    "pharmacy pills", "diet pills", "spam farm", "link farm", "ads track", "ad tracker", "click ads", "banner ads", "pop ads", "payday loans", "fast loan cash", "win prize free", "lottery win", "crack warez", "keygen crack",
    "torrent pirate", "fake watches", "replica bags", "gambling bonus", "malware download", "phishing login", "bet bonus", "jackpot win", "hack cheats", "betting odds", "nude cams",
)
ALLOW_NAMES = (
    "news daily", "city news", "weather report", "science journal", "open data", "public library", "health care", "school district", "university press", "travel guide", "cooking recipes", "garden blog", "music review",
    "book club", "film archive", "history museum", "art gallery", "tech blog", "developer docs", "code wiki", "help forum", "sports news", "football club", "local government", "online shop", "car parts", "home design", "photo blog",
    "market report", "bank account", "job board", "language course", "math lessons", "research lab", "energy policy", "city council", "free software", "data track", "farm house", "video lessons", "www", "blog", "m", "en", "fr", "de", "es", "html", "index", "page", "about", "contact", "article",
)
#: Parts of a host that say nothing, and what may stand before it.
ENDINGS = frozenset({"com", "net", "org", "edu", "gov", "info", "io", "co", "uk", "example"})


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path). Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end."""
    ok = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(ok, ascii_lower(host)).otherwise(F.lit("")), F.when(ok, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path start) that fits the host or one of its subdomains; null where none does.

    Of rules of one length the first in the order of their text wins.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in reversed(ranked):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Viterbi over a unigram model: probabilities of words; unknown words of n letters get UNKNOWN / 10 ** n.

    Nothing here depends on how large the corpus was, so a table that is repeated splits names as before.
    """

    def __init__(self, words: dict[str, float]) -> None:
        self.cost = {w: -math.log(p) for w, p in words.items()}
        self.sizes = sorted(set(map(len, words)), reverse=True)

    def split(self, name: str) -> list[str]:
        """O(length x different lengths of words). Adjacent unknown letters form one word; of equal splits the one with the longest last word."""
        n, rare, step = len(name), -math.log(UNKNOWN), math.log(10)
        # known[i]: cheapest split of name[:i] that ends with a word; other[i]: with an unknown stretch.
        known, other, back = [0.0] + [math.inf] * n, [math.inf] * (n + 1), [0] * (n + 1)
        begun = [0] * (n + 1)
        for i in range(1, n + 1):
            for size in self.sizes:
                if (j := i - size) >= 0 and (w := self.cost.get(name[j:i])) is not None and (c := min(known[j], other[j]) + w) < known[i]:
                    known[i], back[i] = c, j
            go, new = other[i - 1] + step, known[i - 1] + rare + step
            other[i], begun[i] = (go, begun[i - 1]) if go <= new else (new, i - 1)
        words, i = [], n
        while i > 0:
            j = back[i] if known[i] <= other[i] else begun[i]
            words.append(name[j:i])
            i = j
        return words[::-1]


def word_shares(texts: DataFrame, column: str) -> DataFrame:
    """w, p: every word of a column of pages, tags and scripts left out, and its share of all words; beside them, with SEEDED of all shares, the words of the example names."""
    bare = F.regexp_replace(F.coalesce(column, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    counts = stored(texts.select(F.explode(F.split(ascii_lower(bare), "[^a-z0-9]+")).alias("w")).where("w != ''").groupBy("w").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    seeds = Counter(w for name in (*BLOCK_NAMES, *ALLOW_NAMES) for w in name.split())
    own = texts.sparkSession.createDataFrame([(w, n / sum(seeds.values())) for w, n in sorted(seeds.items())], "w string, s double")
    p = (1 - SEEDED) * F.coalesce("n", F.lit(0)) / F.lit(max(total, 1)) + SEEDED * F.coalesce("s", F.lit(0.0))
    return stored(counts.join(own, "w", "full").select("w", p.alias("p")), "shares")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(no, name) -> no, w: the different pieces of a name of up to PIECE letters."""
    for b in batches:
        nos, words = [], []
        for no, name in zip(b["no"], b["name"], strict=True):
            found = {name[i : i + n] for n in range(1, PIECE + 1) for i in range(len(name) - n + 1)}
            nos += [no] * len(found)
            words += found
            if len(words) >= PIECES:
                for at in range(0, len(words), PIECES):
                    yield pd.DataFrame({"no": nos[at : at + PIECES], "w": words[at : at + PIECES]})
                nos, words = [], []
        yield pd.DataFrame({"no": pd.Series(nos, dtype="int64"), "w": pd.Series(words, dtype=object)})


def segment(names: DataFrame, shares: DataFrame) -> DataFrame:
    """(name) distinct, (w, p) -> name, words: each name split with all the words of the corpus that stand in it.

    A name's pieces look up their shares; words of more than PIECE letters are found by their first PIECE ones. Pieces
    carry the number of their name alone, so that a name of n letters makes some PIECE n short rows, however long it is.
    What one name found is one row, bounded by its length; the dictionary is never in one place, however large it is.
    """
    names = stored(names.withColumn("no", F.monotonically_increasing_id()), "names")
    pieces = stored(names.select("no", "name").mapInPandas(_pieces, "no long, w string"), "pieces")
    heavy = stored(heavy_keys(pieces, "w"), "heavy")
    found = spread_join(pieces, shares, "w", heavy).select("no", "w", "p")
    long_words = shares.where(F.length("w") > PIECE).select(F.substring("w", 1, PIECE).alias("start"), "w", "p")
    starts = pieces.where(F.length("w") == PIECE).withColumnRenamed("w", "start")
    found = found.unionByName(spread_join(starts, long_words, "start", heavy.withColumnRenamed("w", "start")).select("no", "w", "p"))
    known = found.groupBy("no").agg(F.collect_list(F.struct("w", "p")).alias("known"))

    @F.pandas_udf("array<string>")
    def split(names: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([Segmenter({x["w"]: x["p"] for x in k} if k is not None else {}).split(n) for n, k in zip(names, known, strict=True)], dtype=object)

    return names.join(known, "no", "left").select("name", split("name", "known").alias("words"))


def _seed_odds() -> tuple[dict[str, tuple[float, float]], tuple[float, float], float]:
    """({word: shares in (block, allow) example names, add-one smoothed}, shares of any other word, share of block names)."""
    each = [Counter(w for name in names for w in name.split()) for names in (BLOCK_NAMES, ALLOW_NAMES)]
    every = sorted(set(each[0]) | set(each[1]))
    sizes = [sum(c.values()) + len(every) + 1 for c in each]
    return {w: tuple((1 + c[w]) / n for c, n in zip(each, sizes, strict=True)) for w in every}, tuple(1 / n for n in sizes), len(BLOCK_NAMES) / (len(BLOCK_NAMES) + len(ALLOW_NAMES))


def bayes_odds(said: DataFrame) -> tuple[DataFrame, float]:
    """(url, ruled, w) -> (w, odds: log odds of block against allow; the prior's log odds).

    Multinomial naive Bayes, learnt from the urls that a rule has judged, and, with equal weight, from the example names.
    Words that neither holds are left out and say nothing.
    """
    seeds, rest, share = _seed_odds()
    ruled = said.where(F.col("ruled").isNotNull())
    is_block = (F.col("ruled") == "block").cast("long")
    words = ruled.groupBy("w").agg(F.sum(is_block).alias("b"), F.sum(1 - is_block).alias("a"))
    sums = words.agg(F.sum("b"), F.sum("a")).first()
    docs = ruled.select("url", "ruled").distinct().agg(F.sum(is_block), F.count("*")).first()
    own = said.sparkSession.createDataFrame([(w, *q) for w, q in seeds.items()], "w string, qb double, qa double")
    p = lambda n, total, q, other: F.coalesce(n, F.lit(0)) / F.lit(total or 1) + F.coalesce(q, F.lit(other))
    odds = words.join(own, "w", "full").select("w", (F.log(p("b", sums[0], "qb", rest[0])) - F.log(p("a", sums[1], "qa", rest[1]))).alias("odds"))
    block = share if not docs[1] else (docs[0] / docs[1] + share) / 2
    return odds, math.log(block / (1 - block))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = 0.0) -> DataFrame:
    """(page_id, url, html) -> page_id, url, host, path, rule, score, verdict: one row per page row.

    The rule's verdict, where one fits; else block if the log odds of the name's words exceed ``threshold``. The words are
    those of the segmented names in host and path; top-level domains, other endings and mere numbers are left out. A null or
    unusable url has empty host and path, no words, and so the prior's score. Names are split and urls judged once,
    however many rows hold them; what very many rows share is joined by broadcast, so hot hosts and urls stay spread. Null
    texts hold no words, repeated rows and ids are judged alike, row by row. Names of any length are split whole. Other
    columns are not looked at. An empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("key"), "url")
    urls = rows.groupBy("key").agg(F.count("*").alias("n")).withColumn("url", F.col("key")).select("key", "n", host.alias("host"), path.alias("path"))
    # from here on a url is a number: its text would go along with each of its words
    urls = stored(urls.withColumns({"rule": rule, "ruled": verdict, "no": F.monotonically_increasing_id()}), "urls")
    parts = F.split("host", r"\.")
    parts = F.when(F.size(parts) > 1, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)  # the last one is the top-level domain
    in_host = F.flatten(F.transform(F.filter(parts, lambda x: ~x.isin(*sorted(ENDINGS))), lambda x: F.filter(F.split(x, "[^a-z0-9]+"), lambda w: w != "")))
    in_path = F.filter(F.split(ascii_lower(F.col("path")), "[^a-z0-9]+"), lambda w: (w != "") & ~w.rlike("^[0-9]+$"))
    named = stored(urls.select(F.col("no").alias("url"), "ruled", F.explode(F.concat(in_host, in_path)).alias("name")), "names")
    split = stored(segment(named.select("name").distinct(), word_shares(pages, "html")), "split")
    said = spread_join(named, split, "name", stored(heavy_keys(named, "name"), "heavy"))
    said = stored(said.select("url", "ruled", F.explode("words").alias("w")), "said")
    odds, prior = bayes_odds(said)
    scored = spread_join(said, stored(odds, "odds"), "w", stored(heavy_keys(said, "w"), "heavy")).groupBy("url").agg(F.sum("odds").alias("odds"))
    scored = urls.join(scored.withColumnRenamed("url", "no"), "no", "left").withColumn("score", F.round(F.lit(prior) + F.coalesce("odds", F.lit(0.0)), 9))
    scored = stored(scored.select("key", "n", "host", "path", "rule", "ruled", "score"), "scored")
    heavy = scored.where(F.col("n") > max(1_000, (scored.agg(F.sum("n")).first()[0] or 0) // 1_000)).select("key")  # a thousand at most
    out = spread_join(rows, scored, "key", heavy)
    return out.select("page_id", "url", "host", "path", "rule", "score", F.coalesce("ruled", F.when(F.col("score") > threshold, "block").otherwise("allow")).alias("verdict"))
