"""Near copies of the pipeline's stage: exact similarity by brute force."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from tidewatch.llm import jaccard, simhash_dedup

from test_prints import find


def brute_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    sets, parent = [brute_shingles(t) for t in texts], list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x == sets[j] or 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(len(texts))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def copies(seed):
    """Edits of some bases, chains of edits, one large group, common lines."""
    rng = random.Random(seed)
    line = [f"line{i}" for i in range(12)]
    out = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 160))] + line * rng.randrange(2)
        out.append(base)
        out += [edited(rng, base, rng.randrange(1, 6)) for _ in range(4)]
        for _ in range(3):
            base = edited(rng, base, 2)
            out.append(base)
    base = [f"b{i}" for i in range(150)]
    out += [edited(rng, base, rng.randrange(1, 4)) for _ in range(60)]
    texts = [" ".join(w) for w in out] + ["A b", "a  B", "", None, " \n", "one two three four five", "one two three four five six"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,most", [(1, 5), (2, 10**9), (3, 2)])
def test_stage_keeps_one_of_each_group_of_brute_force(spark, monkeypatch, seed, most):
    monkeypatch.setattr(jaccard, "FREQUENT", most)
    texts = copies(seed)
    want = set(brute_groups(texts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = corpus_pipeline.near_dedup_stage(spark, df, "")
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)


def test_stage_takes_what_three_bits_miss(spark):
    """Two documents of the given tables, 5 bits and 0.967 apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id IN (2, 56)")
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()] == [2]


def test_stage_of_nothing_and_of_clashing_columns(spark, documents, no_documents):
    assert corpus_pipeline.near_dedup_stage(spark, no_documents, "").count() == 0
    kept = corpus_pipeline.near_dedup_stage(spark, documents, "")
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 10_009 in ids and 10_010 not in ids


def body(k):
    return " ".join(f"t{k}x{i}" for i in range(30))


#: Null ids alone, null ids beside a smaller one, two texts of one id, a twin in another group.
ROWS = [
    (None, body(0)), (None, body(1)), (None, body(1)), (None, body(2)), (9, body(2)), (5, body(3)), (5, body(4)), (3, body(4)), (7, body(5)), (7, body(5)), (None, None), (None, ""),
]


@pytest.mark.parametrize("keep", [simhash_dedup.keep_one, jaccard.keep_one])
def test_each_component_keeps_one_row(spark, keep):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["text"] or "") for r in keep(df).collect())
    assert got == Counter([(None, body(0)), (None, body(1)), (9, body(2)), (5, body(3)), (3, body(4)), (7, body(5)), (None, "")])
