"""Quality classifier: histogram gradient-boosted trees over document statistics, in numpy.

Statistics of whole texts are binned by quantiles; each tree grows level by level from histograms of gradients and
curvatures; fitted trees are flattened into arrays, so that a batch walks all trees at once, one numpy step a level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, held_out, stored, tidy

#: Labelled rows that a model is fitted on at most: those with the smallest hashes of their ids.
FIT_ROWS = 20_000

_KIND = np.zeros(256, np.int64)  # of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sentence mark, 7 other mark, 8 beyond ASCII
for _c, _k in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), ((32, 9, 13), 4), ((10,), 5), (b".,;:?'\"-()", 6), (range(128, 256), 8)):
    for _x in _c:
        _KIND[_x] = _k
for _x in range(33, 127):
    if _KIND[_x] == 0:
        _KIND[_x] = 7
NAMES = (
    "bytes", "words", "lower", "upper", "digits", "spaces", "line_ends", "sentence_marks", "other_marks", "beyond_ascii", "word_length", "word_spread", "longest_word",
    "distinct_words", "commonest_word", "distinct_lines", "line_words", "capital_words", "marked_words", "ends_with_mark",
)


def statistics(text: str | None) -> list[float]:
    """The numbers of NAMES over the whole text; null counts as empty, whose numbers are all zero."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    n, m = len(data), len(words)
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=9) / n
    lens = np.fromiter(map(len, words), np.int64, m)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    firsts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    lasts = _KIND[np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)]
    return [
        np.log1p(n), np.log1p(m), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], kinds[8], lens.mean(), lens.std(), np.log1p(lens.max()),
        len(counts) / m, max(counts.values()) / m, len(set(lines)) / len(lines), np.log1p(m / len(lines)), (_KIND[firsts] == 2).mean(), (lasts == 7).mean(), float(lasts[-1] == 6),
    ]


class BoostedTrees:
    """Binary, logistic loss. After fit() all nodes of all trees lie in four arrays; leaves point to themselves."""

    def __init__(self, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 5.0) -> None:
        self.trees, self.depth, self.bins, self.rate, self.ridge, self.least = trees, depth, bins, rate, ridge, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1)
        p = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        feature, cut, child, value, self.roots = [], [], [], [], []
        raw = np.full(n, self.base)
        for _ in range(self.trees if n else 0):
            prob = 1 / (1 + np.exp(-raw))
            g, h = y - prob, np.maximum(prob * (1 - prob), 1e-9)
            node = np.full(n, len(feature))
            self.roots.append(len(feature))
            level = [len(feature)]
            feature.append(0), cut.append(np.inf), child.append(len(feature) - 1), value.append(0.0)
            for depth in range(self.depth + 1):
                first, k = level[0], len(level)
                at = node >= first
                own = node[at] - first
                gs, hs = np.bincount(own, g[at], k), np.bincount(own, h[at], k)
                for i, nd in enumerate(level):
                    value[nd] = self.rate * gs[i] / (hs[i] + self.ridge)
                if depth == self.depth:
                    break
                gain = np.full((k, width, self.bins), -np.inf)
                for f in range(width):
                    key = own * self.bins + binned[at, f]
                    gl = np.bincount(key, g[at], k * self.bins).reshape(k, -1).cumsum(1)
                    hl = np.bincount(key, h[at], k * self.bins).reshape(k, -1).cumsum(1)
                    gr, hr = gs[:, None] - gl, hs[:, None] - hl
                    ok = (hl * 4 >= self.least * 0.1) & (hr * 4 >= self.least * 0.1)
                    gain[:, f] = np.where(ok, gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - (gs**2 / (hs + self.ridge))[:, None], -np.inf)
                nxt: list[int] = []
                for i, nd in enumerate(level):
                    f, b = divmod(int(gain[i].argmax()), self.bins)
                    if gain[i, f, b] > 1e-6 and b < len(self.edges[f]):
                        feature[nd], cut[nd], child[nd] = f, float(self.edges[f][b]), len(feature)
                        for _side in range(2):
                            nxt.append(len(feature))
                            feature.append(0), cut.append(np.inf), child.append(len(feature) - 1), value.append(0.0)
                        here = node == nd
                        node[here] = child[nd] + (binned[here, f] > b)
                if not nxt:
                    break
                level = nxt
            raw = raw + np.array(value)[node]
        self.feature, self.cut, self.child, self.value = np.array(feature, np.int32), np.array(cut), np.array(child, np.int32), np.array(value)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, all trees walked at once: node + (not below the cut) along ``child``; a leaf's cut is infinite."""
        raw = np.full(len(x), self.base)
        if self.roots and len(x):
            node = np.tile(np.array(self.roots, np.int32), (len(x), 1))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                node = self.child[node] + (x[rows, self.feature[node]] > self.cut[node])
            raw = raw + self.value[node].sum(1)
        return 1 / (1 + np.exp(-raw))


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, k, y, text) -> doc_id, k, y, stats array<double>."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "k": b["k"], "y": b["y"], "stats": [statistics(t) for t in b["text"]]})
            tidy()

    return docs.select("doc_id", "k", "y", "text").mapInPandas(run, "doc_id long, k long, y int, stats array<double>")


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` document rows (doc_id, k, y, text) that may be learnt from, stored; k is a hash of the text.

    Rows of one doc_id with different texts are each a row, copies of a row one. An id with several labels takes the
    highest. The chosen ids are at most ``most`` and so broadcast, and of their rows again at most ``most`` stay: those
    with the smallest hashes of id and text.
    """
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.max("y").alias("y")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.xxhash64("text").alias("k"), "text").join(F.broadcast(chosen), "doc_id")
    keys = rows.select("doc_id", "k").distinct().orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k").limit(most)
    return stored(rows.join(F.broadcast(keys), ["doc_id", "k"], "left_semi").dropDuplicates(["doc_id", "k"]), "labelled")


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> BoostedTrees:
    """A model of labels.quality. Held-out rows (see common.held_out) are never learnt from; unlabelled tables give a constant one half."""
    learn = labelled(docs, labels, "quality", most)
    rows = with_statistics(learn).orderBy("doc_id", "k").collect()  # at most ``most``
    dropped(learn)
    x = np.array([r["stats"] for r in rows], np.float64).reshape(len(rows), len(NAMES))
    return BoostedTrees().fit(x, np.array([float(r["y"]) for r in rows]))


def score(docs: DataFrame, model: BoostedTrees, column: str = "score") -> DataFrame:
    """All columns of docs and the probability of good quality of each row's whole text, null and empty ones included.

    Rows are judged one by one: ties and repeated rows get equal scores; a column that is already called as the new one
    is replaced. An empty table stays empty.
    """

    @F.pandas_udf("double")
    def judged(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))
        tidy()
        return pd.Series(np.concatenate([model.predict(x[i : i + 1024]) for i in range(0, len(x), 1024)]) if len(x) else np.zeros(0))

    return docs.withColumn(column, judged("text"))
