"""Each stage of the pipeline on odd rows, held against brute force: nulls, empty and very long texts, repeats, further columns of any name, empty tables."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_dedup import plain_fingerprint, removed
from test_models import plain_statistics
from tokenizers import Tokenizer

import corpus_pipeline
from lodestone.llm import quality

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Further columns, some called as the operators call their own.
EXTRA = ("__score", "_score", "score", "id", "key", "n", "k", "y", "h", "hits", "rank", "block", "first", "firsts", "spans", "root", "length", "shard")


@pytest.fixture(scope="module")
def odd(spark):
    """The documents and odd rows, each with a number of its own in every further column; rows that repeat agree in all."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(4)
    words = [w for d in docs for w in (d[1] or "").split()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = text(20_000)
    more = [(None, text(120)), (None, None), (10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (10**6 + 3, long), (10**6 + 4, long + " again"), (10**6 + 5, f"{text(20)} {item} {text(20)}"), (10**6 + 6, f"{text(5_000)} {item}"), (2**53 + 1, docs[0][1])]
    rows = docs + [(d, t, "xx", "odd", len(t or "")) for d, t in more]
    rows += [rows[3], rows[3], rows[-1], rows[len(docs)], rows[len(docs) + 2]]
    numbers = {r: i for i, r in enumerate(dict.fromkeys(rows))}
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for c in EXTRA:
        schema = schema.add(c, "long")
    return spark.createDataFrame([(*r, *[numbers[r]] * len(EXTRA)) for r in rows], schema)


def applied(spark, name, docs):
    """(columns, rows) of a stage, written and read as the pipeline does."""
    path = f"{corpus_pipeline.workspace(spark)}/odd-{random.getrandbits(60)}"
    STAGES[name](spark, docs, SF).write.parquet(path)
    out = spark.read.parquet(path)
    return out.columns, out.collect()


def counted(rows, *skip):
    return Counter(tuple((c, r[c]) for c in r.__fields__ if c not in skip) for r in rows)


def test_quality_keeps_what_scores_well(spark, odd):
    columns, got = applied(spark, "quality classifier", odd)
    model = quality.fit(odd, spark.read.parquet(f"{SF}/labels.parquet"))

    def score(text):
        x, raw = plain_statistics(text), model.base
        for n in model.roots:
            while model.child[n] != n:
                n = model.child[n] + int(x[model.feature[n]] > model.cut[n])
            raw += model.value[n]
        return 1 / (1 + np.exp(-raw))

    rows = odd.collect()
    want = [r for r in rows if score(r.text) >= 0.7]
    assert columns == odd.columns and counted(got) == counted(want) and 0 < len(want) < len(rows)


def test_one_of_each_group_stays(spark, odd):
    columns, got = applied(spark, "SimHash near-dedup", odd)
    rows = odd.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    # the smallest id; where no row has one, any row without
    first = Counter(min((r.doc_id is None, r.doc_id or 0) for r in g) for g in groups.values())
    assert columns == odd.columns and Counter((r.doc_id is None, r.doc_id or 0) for r in got) == first
    assert not counted(got) - counted(rows) and len(got) < len(rows)


def test_repeats_go(spark, odd):
    columns, got = applied(spark, "suffix-array dedup", odd)
    rows = odd.collect()
    left = [None if r.text is None else x[4].decode("utf-8", "replace") for r, x in zip(rows, removed([r.text for r in rows]), strict=True)]
    want = Counter((r.doc_id, t, r.key, r.spans) for r, t in zip(rows, left, strict=True))
    assert columns == odd.columns and Counter((r.doc_id, r.text, r.key, r.spans) for r in got) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert any(t is not None and len(t) < len(r.text) for r, t in zip(rows, left, strict=True))


def test_contaminated_documents_go(spark, odd):
    columns, got = applied(spark, "benchmark decontamination", odd)
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = cut(r.text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12)) if w}

    def clean(text):
        w, hit = cut(text), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        return not hit or 20 * len(hit) < len(w)

    rows = odd.collect()
    want = [r for r in rows if clean(r.text)]
    assert columns == odd.columns and counted(got) == counted(want)
    gone = {r.doc_id for r in rows} - {r.doc_id for r in got}
    assert 10**6 + 5 in gone and 10**6 + 6 not in gone


def test_all_is_packed(spark, odd):
    _, got = applied(spark, "best-fit packing", odd)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in odd.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, len(ids)] if len(ids) <= 1024 else [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want.update((r.doc_id, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 1024
    # best fit, one piece after the other, longest first
    room = []
    for n in sorted((r.length for r in got), reverse=True):
        at = min((i for i, x in enumerate(room) if x >= n), key=room.__getitem__, default=None)
        if at is None:
            room.append(1024 - n)
        else:
            room[at] -= n
    assert -(-sum(r.length for r in got) // 1024) <= len(bins) <= len(room)


@pytest.mark.parametrize("name", STAGES)
def test_empty_tables_stay_empty(spark, odd, name):
    columns, got = applied(spark, name, odd.limit(0))
    assert got == [] and (columns == odd.columns or name == "best-fit packing")


def test_nothing_is_learnt_from_names(spark, odd):
    """The further columns and the order of the rows say nothing about what is kept."""
    plain = odd.drop(*EXTRA).orderBy(F.desc("n_chars"))
    kept = Counter(r.doc_id for r in applied(spark, "quality classifier", odd)[1])
    assert Counter(r.doc_id for r in applied(spark, "quality classifier", plain)[1]) == kept
