"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, all in numpy.

A word's input is the embedding of the word itself, if it was frequent in training, beside the mean of the embeddings of
its hashed character n-grams, so that unseen forms of a known stem are understood. Two recurrent nets read a window of
words forwards and backwards; attention weighs their states; a logistic unit judges the pooled state. A text is cut into
overlapping windows that cover all of it, and its score is that of its worst window, calibrated on training texts.

Everything that a word contributes to the gates is worked out once for each distinct word and then looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored, tidy
from .quality import labelled

#: Labelled rows fitted on at most, words of a window, words between two windows' starts.
FIT_ROWS, WINDOW, STRIDE = 4_000, 48, 32
#: Rounds of looking at all windows of these rows and learning from the ones that look worst; how many of a text a round adds.
ROUNDS, HARDEST = 2, 6
#: Embedded words, buckets of character n-grams, sizes of either embedding, of a direction's state and of the attention.
VOCABULARY, BUCKETS, SIZE, STATE, ATTENTION = 4_096, 1 << 15, 8, 8, 8
#: Distinct words whose gate inputs a worker remembers.
REMEMBERED = 300_000

_CLEAN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of letters, digits and non-ASCII characters of the whole text."""
    return (text or "").lower().encode("utf-8", "replace").translate(_CLEAN).split()


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all 3- to 5-grams of ``^word$``, word by word; where each word's begin). Every word has at least one."""
    data = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    lens = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    own = np.repeat(np.arange(len(words)), lens)
    keys, whose = [], []
    hashed = data * np.uint32(2654435761)
    for n in range(1, 5):
        if len(data) <= n:
            break
        hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint32(15))) * np.uint32(2246822519) + data[n:] * np.uint32(3266489917)
        if n >= 2:
            inside = own[: len(hashed)] == own[n:]
            keys.append(((hashed[inside] ^ (hashed[inside] >> np.uint32(16))) % np.uint32(BUCKETS)).astype(np.int32))
            whose.append(own[: len(hashed)][inside])
    key, at = np.concatenate(keys), np.concatenate(whose)
    order = np.argsort(at, kind="stable")
    return key[order], np.searchsorted(at[order], np.arange(len(words)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """(n, columns): the rows of each number added up."""
    return np.stack([np.bincount(at, column, n) for column in rows.T], 1).astype(rows.dtype)


class Network:
    """Parameters in ``p``; fit() trains them, windows() judges windows of word numbers."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        d, h = 2 * SIZE, STATE
        make = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.vocabulary: dict[bytes, int] = {}
        self.p = {
            "word": 0.1 * make(VOCABULARY + 1, SIZE) * 8, "char": 0.1 * make(BUCKETS, SIZE) * 32, "in": make(d, 6 * h), "bias": np.zeros(6 * h, np.float32),
            "fwd": make(h, 3 * h), "bwd": make(h, 3 * h), "att": make(2 * h, ATTENTION), "pick": make(ATTENTION), "out": make(2 * h), "base": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0
        self.slope, self.shift = 1.0, 0.0

    def spelled(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers in the vocabulary, all n-gram buckets word by word, how many each word has)."""
        keys, starts = ngrams(words)
        return np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words)), keys, np.diff(np.append(starts, len(keys)))

    def embed(self, spelled: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Inputs of distinct words (n, 2 * SIZE)."""
        at, keys, sizes = spelled
        chars = np.add.reduceat(self.p["char"][keys], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][at], chars], 1)

    def gates(self, words: list[bytes]) -> np.ndarray:
        return self._gates(self.spelled(words))

    def _gates(self, spelled: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        return self.embed(spelled) @ self.p["in"] + self.p["bias"]

    @staticmethod
    def _run(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: bool) -> tuple[np.ndarray, list]:
        """One direction: x (T, B, 3 * STATE) -> states (T, B, STATE)."""
        h, out, kept, s = np.zeros((x.shape[1], STATE), np.float32), np.empty((*x.shape[:2], STATE), np.float32), [], STATE
        for t in range(len(x)):
            a = h @ u
            zr = _sigmoid(x[t, :, : 2 * s] + a[:, : 2 * s])
            z, r = zr[:, :s], zr[:, s:]
            n = np.tanh(x[t, :, 2 * s :] + r * a[:, 2 * s :])
            new = n + z * (h - n)
            if mask is not None:
                new = new * mask[t][:, None]
            if keep:
                kept.append((h, z, r, n, a[:, 2 * s :]))
            out[t] = h = new
        return out, kept

    def forward(self, table: np.ndarray, at: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Logits of windows. table: gate inputs by word number; at (B, T): word numbers, -1 where a window is shorter."""
        mask = None if (at >= 0).all() else (at.T >= 0).astype(np.float32)
        x = table[at.T]
        fwd, kept_f = self._run(x[:, :, : 3 * STATE], self.p["fwd"], mask, keep)
        bwd, kept_b = self._run(x[::-1, :, 3 * STATE :], self.p["bwd"], None if mask is None else mask[::-1], keep)
        states = np.concatenate([fwd, bwd[::-1]], 2)
        hidden = np.tanh(states @ self.p["att"])
        weight = np.exp(hidden @ self.p["pick"])
        if mask is not None:
            weight = weight * mask
        weight = weight / np.maximum(weight.sum(0), 1e-9)
        pooled = (weight[:, :, None] * states).sum(0)
        return pooled @ self.p["out"] + self.p["base"][0], (mask, kept_f, kept_b, states, hidden, weight, pooled)

    def _back_run(self, d: np.ndarray, kept: list, u: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        dx, du, dh, s = np.empty((*d.shape[:2], 3 * STATE), np.float32), np.zeros_like(u), np.zeros(d.shape[1:], np.float32), STATE
        for t in range(len(d) - 1, -1, -1):
            h, z, r, n, an = kept[t]
            g = d[t] + dh
            if mask is not None:
                g = g * mask[t][:, None]
            dn = g * (1 - z) * (1 - n * n)
            dz = g * (h - n) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dn], 1)
            da = np.concatenate([dz, dr, dn * r], 1)
            du += h.T @ da
            dh = g * z + da @ u.T
        return dx, du

    def gradients(self, spelled: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of windows of these words' numbers, and its gradient by every parameter."""
        word_at, keys, sizes = spelled
        vectors = self.embed(spelled)
        table = vectors @ self.p["in"] + self.p["bias"]
        logits, (mask, kept_f, kept_b, states, hidden, weight, pooled) = self.forward(table, at, True)
        loss = float(np.mean(np.logaddexp(0, logits) - y * logits))
        d = ((_sigmoid(logits) - y) / len(y)).astype(np.float32)
        g: dict[str, np.ndarray] = {"out": pooled.T @ d, "base": np.array([d.sum()], np.float32)}
        dp = d[:, None] * self.p["out"]
        dw = (states * dp).sum(2)
        ds = weight * (dw - (weight * dw).sum(0))
        g["pick"] = np.einsum("tb,tba->a", ds, hidden)
        da = ds[:, :, None] * self.p["pick"] * (1 - hidden**2)
        g["att"] = np.einsum("tbs,tba->sa", states, da)
        dstates = weight[:, :, None] * dp + da @ self.p["att"].T
        dxf, g["fwd"] = self._back_run(dstates[:, :, :STATE], kept_f, self.p["fwd"], mask)
        dxb, g["bwd"] = self._back_run(dstates[::-1, :, STATE:], kept_b, self.p["bwd"], None if mask is None else mask[::-1])
        dx = np.concatenate([dxf, dxb[::-1]], 2).reshape(-1, 6 * STATE)
        flat = at.T.reshape(-1)
        dt = _summed(flat[flat >= 0], dx[flat >= 0], len(table))
        g["bias"], g["in"] = dt.sum(0), vectors.T @ dt
        dv = dt @ self.p["in"].T
        g["word"] = _summed(word_at, dv[:, :SIZE], len(self.p["word"]))
        g["word"][0] = 0
        g["char"] = _summed(keys, np.repeat(dv[:, SIZE:] / sizes[:, None].astype(np.float32), sizes, axis=0), len(self.p["char"]))
        return loss, g

    def start(self, words: dict[bytes, np.ndarray], grams: np.ndarray, totals: np.ndarray) -> Network:
        """First numbers of the embeddings: how much oftener toxic texts hold the word or n-gram; zero where little was seen.

        words: how many (clean, toxic) texts hold each word that gets an embedding of its own; grams: the same for the words
        of each n-gram bucket; totals: how many texts there are of either kind.
        """
        odds = lambda c: np.clip(np.log((c[:, 1] + 0.5) / (totals[1] + 1)) - np.log((c[:, 0] + 0.5) / (totals[0] + 1)), -3, 3) * (c.sum(1) / (c.sum(1) + 5))
        self.vocabulary = {w: i + 1 for i, w in enumerate(words)}
        self.p["char"][:, 0] = odds(grams)
        if words:
            self.p["word"][1 : len(words) + 1, 0] = odds(np.array(list(words.values()), np.float64))
        return self

    def fit(self, windows: list[tuple[int, float, list[bytes]]], epochs: int = 5, least_steps: int = 300, batch: int = 256, rate: float = 0.01, seed: int = 5) -> Network:
        """windows: (text number, its label, words). At least ``epochs`` rounds and about ``least_steps`` steps. Each epoch learns from all given windows of clean texts and, of a toxic text, from the one that looks worst."""
        if not windows:
            return self
        words = sorted({w for _, _, ws in windows for w in ws})
        number = {w: i for i, w in enumerate(words)}
        at = np.full((len(windows), WINDOW), -1, np.int64)
        for i, (_, _, ws) in enumerate(windows):
            at[i, : len(ws)] = [number[w] for w in ws]
        doc, y = np.array([d for d, _, _ in windows]), np.array([v for _, v, _ in windows], np.float32)
        word_at, keys, sizes = every = self.spelled(words)
        starts = np.cumsum(sizes) - sizes
        rng = np.random.default_rng(seed)
        m, v, step = {k: np.zeros_like(p) for k, p in self.p.items()}, {k: np.zeros_like(p) for k, p in self.p.items()}, 0
        for epoch in range(epochs := max(epochs, -(-least_steps // max(1, int((y == 0).sum()) // batch)))):
            looks = self.windows(self._gates(every), at)
            worst = np.lexsort((-looks, doc))
            worst = worst[np.concatenate([[True], doc[worst][1:] != doc[worst][:-1]])]
            use = np.concatenate([np.flatnonzero(y == 0), worst[y[worst] == 1]])
            lr = rate * (1 - epoch / epochs) + 1e-4
            for part in np.array_split(rng.permutation(use), max(1, len(use) // batch)):
                here, inverse = np.unique(at[part], return_inverse=True)
                inverse = inverse.reshape(len(part), WINDOW)
                if here[0] < 0:
                    here, inverse = here[1:], inverse - 1
                if not len(here):
                    continue
                n = sizes[here]
                own = keys[np.repeat(starts[here] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                _, g = self.gradients((word_at[here], own, n), inverse, y[part])
                step += 1
                for k, p in self.p.items():
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    p -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling by Newton's method; a little ridge keeps separable data finite."""
        x = x.astype(np.float64)

        def loss(a: float, b: float) -> float:
            return float(np.sum(np.logaddexp(0, a * x + b) - y * (a * x + b)) + 0.005 * ((a - 1) ** 2 + b * b))

        a, b = 1.0, 0.0
        for _ in range(50):
            p = _sigmoid(a * x + b)
            e, w = p - y, np.maximum(p * (1 - p), 1e-9)
            grad = np.array([(e * x).sum() + 0.01 * (a - 1), e.sum() + 0.01 * b])
            hess = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
            da, db = np.linalg.solve(hess, grad)
            size = 1.0
            while size > 1e-6 and loss(a - size * da, b - size * db) > loss(a, b):
                size /= 2
            a, b = float(max(a - size * da, 0.05)), float(b - size * db)
        self.slope, self.shift = a, b

    def windows(self, table: np.ndarray, at: np.ndarray, batch: int = 1024) -> np.ndarray:
        return np.concatenate([self.forward(table, at[i : i + batch])[0] for i in range(0, len(at), batch)]) if len(at) else np.zeros(0, np.float32)


def cut(n: int) -> np.ndarray:
    """Starts of the windows over n words: every STRIDE words, the last one ending with the text."""
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW) if n > WINDOW else np.zeros(1, np.int64)


class Scorer:
    """Scores texts with a network; remembers the gate inputs of the words it has met."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.table, self.filled = np.zeros((1 << 14, 6 * STATE), np.float32), 0

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        new = list(set(words).difference(self.number))
        if len(self.number) + len(new) > REMEMBERED and self.number:
            self._forget()
            new = list(set(words))
        if new:
            if self.filled + len(new) > len(self.table):
                self.table = np.concatenate([self.table[: self.filled], np.zeros((max(len(self.table), len(new)), 6 * STATE), np.float32)])
            for i in range(0, len(new), 1 << 14):
                part = new[i : i + (1 << 14)]
                self.table[self.filled : self.filled + len(part)] = self.network.gates(part)
                self.number.update(zip(part, range(self.filled, self.filled + len(part)), strict=True))
                self.filled += len(part)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def looks(self, words: list[bytes], starts: np.ndarray) -> np.ndarray:
        """Logits of some windows of a text of at least WINDOW words."""
        ids = self._numbers(words)
        return self.network.windows(self.table, ids[starts[:, None] + np.arange(WINDOW)])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of toxicity of each text."""
        return _sigmoid(self.network.slope * self.worst(texts) + self.network.shift)

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Logit of each text's worst window; at about 2 million characters at a time."""
        out: list[np.ndarray] = []
        some: list[list[bytes]] = []
        held = 0
        for t in texts:
            some.append(tokens(t))
            held += len(some[-1])
            if held > 400_000:
                out.append(self._few(some))
                some, held = [], 0
        if some:
            out.append(self._few(some))
        return np.concatenate(out) if out else np.zeros(0)

    def _few(self, docs: list[list[bytes]]) -> np.ndarray:
        ids = self._numbers([w for d in docs for w in d])
        ends = np.cumsum([len(d) for d in docs])
        worst = np.full(len(docs), self.network.p["base"][0], np.float32)  # a text without words has nothing pooled
        whole, short = [], []
        for i, (d, e) in enumerate(zip(docs, ends.tolist(), strict=True)):
            if len(d) >= WINDOW:
                starts = cut(len(d)) + (e - len(d))
                whole.append((np.full(len(starts), i), starts))
            elif d:
                short.append((i, e - len(d), len(d)))
        if whole:
            own, starts = (np.concatenate(x) for x in zip(*whole, strict=True))
            looks = np.concatenate([self.network.forward(self.table, ids[starts[i : i + 1024, None] + np.arange(WINDOW)])[0] for i in range(0, len(starts), 1024)])
            best = np.full(len(docs), -np.inf, np.float32)
            np.maximum.at(best, own, looks)
            worst = np.where(np.isfinite(best), best, worst)
        for i in range(0, len(short), 1024):
            part = short[i : i + 1024]
            at = np.full((len(part), WINDOW), -1, np.int64)
            for k, (_, s, n) in enumerate(part):
                at[k, :n] = ids[s : s + n]
            worst[[x[0] for x in part]] = self.network.forward(self.table, at)[0]
        return worst.astype(np.float64)


def lexicon(learn: DataFrame) -> tuple[dict[bytes, np.ndarray], np.ndarray, np.ndarray]:
    """What Network.start() takes, over all words of all texts of ``learn`` (doc_id, k, y, text).

    Collected are at most VOCABULARY words (those in most texts, in three or more), BUCKETS sums and two totals.
    """

    def said(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for y, t in zip(b["y"], b["text"], strict=True):
                if ws := sorted(set(tokens(t))):
                    yield pd.DataFrame({"w": ws, "toxic": int(y == 1)})
            tidy()

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((BUCKETS, 2))
        for b in batches:
            if len(b):
                keys, starts = ngrams([bytes(w) for w in b["w"]])
                own = np.repeat(np.arange(len(b)), np.diff(np.append(starts, len(keys))))
                for i, c in enumerate(("clean", "toxic")):
                    sums[:, i] += np.bincount(keys, b[c].to_numpy(np.float64)[own], BUCKETS)
        at = np.flatnonzero(sums.any(1))
        yield pd.DataFrame({"g": at, "clean": sums[at, 0], "toxic": sums[at, 1]})

    rows = learn.select("y", "text").mapInPandas(said, "w binary, toxic int")
    words = stored(rows.groupBy("w").agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")), "words")
    top = words.where("clean + toxic >= 3").orderBy(F.desc(F.col("clean") + F.col("toxic")), "w").limit(VOCABULARY).collect()
    found = np.zeros((BUCKETS, 2))
    for r in words.mapInPandas(grams, "g int, clean double, toxic double").groupBy("g").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).collect():
        found[r["g"]] = r["c"], r["t"]
    dropped(words)
    totals = {bool(r["toxic"]): r["n"] for r in learn.groupBy((F.col("y") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    return {bytes(r["w"]): np.array([r["clean"], r["toxic"]], np.float64) for r in top}, found, np.array([totals.get(False, 0), totals.get(True, 0)])


def hardest_windows(learn: DataFrame, network: Network, most: int = HARDEST) -> list[tuple[int, int, int, bytes, int]]:
    """(doc_id, k, start, words, label): of each text the windows that look worst to a network among all its windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(network)
        for b in batches:
            rows = []
            for d, k, y, t in zip(b["doc_id"], b["k"], b["y"], b["text"], strict=True):
                ws = tokens(t)
                starts = cut(len(ws))
                if len(starts) > most:
                    starts = np.sort(starts[np.argsort(-scorer.looks(ws, starts), kind="stable")[:most]])
                rows += [(d, k, s, y, b" ".join(ws[s : s + WINDOW])) for s in starts.tolist()]
            yield pd.DataFrame(rows, columns=["doc_id", "k", "at", "y", "words"])
            tidy()

    taken = learn.select("doc_id", "k", "y", "text").mapInPandas(run, "doc_id long, k long, at long, y int, words binary").collect()  # at most ``most`` a row
    return [(r["doc_id"], r["k"], r["at"], bytes(r["words"]), r["y"]) for r in taken]


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, rounds: int = ROUNDS) -> Network:
    """A network fitted on at most ``most`` labelled rows (labels.toxic), never held-out ones; without labelled rows it is left untrained.

    It starts from the counts of all words of these rows' whole texts. In each round Spark tasks look at all windows of all
    rows with the network as it is, those that look worst in each text join the windows of the rounds before, and the
    network learns on from all of them; so what a long text holds is found wherever it stands. At last it is calibrated on the worst of all windows of each text,
    which is what scoring takes. Windows are collected (at most HARDEST a row and round), texts are not.
    """
    learn = labelled(docs, labels, "toxic", most)
    network = Network().start(*lexicon(learn))
    taken: set[tuple[int, int, int, bytes, int]] = set()
    for r in range(rounds):
        before = len(taken)
        taken |= set(hardest_windows(learn, network))
        if r and len(taken) == before:
            break  # the windows that look worst have been learnt from
        rows = sorted(taken)
        number = {x: i for i, x in enumerate(dict.fromkeys(t[:2] for t in rows))}
        network.fit([(number[t[:2]], float(t[4]), t[3].split()) for t in rows], *((5, 300) if not r else (2, 80)))
    if not taken:
        return network

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(network)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "k": b["k"], "y": b["y"], "look": scorer.worst(list(b["text"]))})
            tidy()

    rows = learn.select("doc_id", "k", "y", "text").mapInPandas(run, "doc_id long, k long, y int, look double").orderBy("doc_id", "k").collect()  # one number a row
    network._calibrate(np.array([r["look"] for r in rows]), np.array([float(r["y"]) for r in rows]))
    dropped(learn)
    return network


def score(docs: DataFrame, network: Network, column: str = "score") -> DataFrame:
    """All columns of docs and each whole text's probability of toxicity, null and empty texts (no words) included.

    Rows are judged one by one: ties and repeated rows get equal scores; a column that is already called as the new one
    is replaced. An empty table stays empty.
    """

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(network)
        for texts in batches:
            yield pd.Series(scorer.scores(list(texts)), dtype="float64")
            tidy()

    return docs.withColumn(column, judged("text"))
