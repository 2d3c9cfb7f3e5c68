"""Trained operators: context-tree weighting against a plain recursion, quality
and toxicity on held-out rows, and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import ctw, quality, simhash_dedup, toxicity


def brute_ctw(train, depth):
    """Nodes (context, decision) -> counts, and the weighted log probability."""
    counts = {}
    for text in train:
        whole = b"\xff" * depth + text + b"\xff"
        for at in range(depth, len(whole)):
            context, byte = whole[at - depth : at][::-1], whole[at]
            for j in range(8):
                node = (1 << j) | (byte >> (8 - j))
                for k in range(depth + 1):
                    counts.setdefault((context[:k], node), [0, 0])[byte >> (7 - j) & 1] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted, own = {}, {}
    for context, node in sorted(counts, key=lambda c: -len(c[0])):
        estimate = kt(*counts[context, node])
        if len(context) == depth:
            weighted[context, node], own[context, node] = estimate, 1.0
        else:
            below = sum(weighted[context + bytes([c]), node] for c in range(256) if (context + bytes([c]), node) in counts)
            both = np.logaddexp(estimate, below) - math.log(2)
            weighted[context, node], own[context, node] = both, math.exp(estimate - math.log(2) - both)

    def predict(context, node, bit, k=0):
        if (context[:k], node) not in counts:
            return None
        a = counts[context[:k], node]
        here = (a[bit] + 0.5) / (sum(a) + 1)
        deeper = predict(context, node, bit, k + 1) if k < depth else None
        w = own[context[:k], node]
        return here if deeper is None else w * here + (1 - w) * deeper

    def score(text):
        whole, total = b"\xff" * depth + text + b"\xff", 0.0
        for at in range(depth, len(whole)):
            context, byte = whole[at - depth : at][::-1], whole[at]
            for j in range(8):
                p = predict(context, (1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1)
                total += math.log10(0.5 if p is None else p)
        return total

    return score


TEXTS = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The  dog\tsat", "", None, "über den Fluss", "the cat", "the cat", "zzz", "a" * 50, "on the mat the dog", "x y z"])]


@pytest.mark.parametrize("depth,roots,block_bytes", [(6, 3, 1 << 20), (3, 1, 10), (5, 2, 40)])
def test_scores_equal_the_recursion(spark, depth, roots, block_bytes):
    df = spark.createDataFrame([*TEXTS, (5, "the cat"), (None, "no id")], "doc_id long, text string").withColumns({"block": F.lit(1), "score": F.lit(2)}).repartition(3)
    docs = [(r["doc_id"], (r["text"] or "").encode().lower().split()) for r in df.collect()]
    fold = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs}
    train = [w for i, w in docs if not fold[i]]
    c = Counter(x for w in train for x in [*w, None])
    n, v = sum(c.values()), len(c)
    model = brute_ctw([b" ".join(w) for w in train], depth)
    want = Counter()
    for i, w in docs:
        base = sum(math.log10((c.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None])
        want[(i, fold[i], len(w) + 1, sum(x in c for x in [*w, None]), n, round(base, 6), round(model(b" ".join(w)), 3))] += 1
    got = ctw.score(df, depth=depth, roots=roots, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 3)) for r in got) == want


def test_a_very_long_text_is_scored_whole(spark):
    """Longer than a block, and beside short ones."""
    words = [f"w{i % 97}x{i % 13}" for i in range(6_000)]
    long = " ".join(words)
    df = spark.createDataFrame([(2, long), (3, long[:2_000]), (4, "w1x1"), (5, long)], "doc_id long, text string").repartition(3)
    small = {r["doc_id"]: r for r in ctw.score(df, block_bytes=1_000).collect()}
    whole = {r["doc_id"]: r for r in ctw.score(df).collect()}
    assert {i: round(r["score"], 2) for i, r in small.items()} == {i: round(r["score"], 2) for i, r in whole.items()}
    assert whole[5]["n_tokens"] == 6_001 and whole[5]["n_bytes"] == len(long) + 1


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    df = spark.createDataFrame([(i, "ab") for i in ids], "doc_id long, text string")
    for r in ctw.score(df).collect():
        assert r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] == pytest.approx(24 * math.log10(0.5))
    assert ctw.score(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        ctw.score(df, depth=8)


def test_held_out_texts_beat_the_base(spark):
    """With a few thousand texts; with a few hundred, counts of words still win."""
    got = [r for r in ctw.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 5)), min_size=1, max_size=20))
def test_pooling_is_the_nearest_rising_sequence(points):
    values, weights = (np.array(x, float) for x in zip(*points, strict=True))
    got = quality.pool_adjacent(values, weights)
    assert len(got) == len(values) and (np.diff(got) >= -1e-9).all()
    # max-min formula
    n = len(values)
    mean = lambda i, j: np.average(values[i : j + 1], weights=weights[i : j + 1])
    for k in range(n):
        want = max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1))
        assert got[k] == pytest.approx(want)


GOOD = "Some ordinary sentence about the weather, and more of it. Another line follows here.\nIt has words of many kinds"
JUNK = ("BUY!! NOW!! CHEAP!! STUFF!!", "word word word word word word word", "a | b | c | d | e", "x$$$ y%%% z&&& w***")


def labelled(spark, n=400):
    rng = np.random.default_rng(0)
    letters = list("abcdefghijklmnop")

    def prose():
        return " ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(rng.integers(30, 80))).capitalize() + "."

    rows = []
    for i in range(n):
        bad = i % 4 == 0
        toxic = i % 5 == 0
        text = " ".join([JUNK[i % len(JUNK)]] * int(rng.integers(3, 9))) if bad else prose()
        if toxic:
            text += " " + " ".join(rng.choice(["vile", "rotten", "nasty"], rng.integers(2, 6)))
        rows.append((i, text, int(not bad), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_quality_on_held_out_rows(spark):
    docs, labels, rows = labelled(spark)
    got = {r["doc_id"]: r for r in quality.classify(docs.withColumns({"stats": F.lit(1), "lang": F.lit("x")}), labels).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert len(held) > 40 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i]["predicted"] == q for i, _, q, _ in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_quality_without_labels_and_with_odd_ones(spark, documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.classify(documents.limit(5), none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, None), (None, 1), (77_777, 1), (2, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    assert quality.classify(documents, odd).count() == documents.count()
    assert quality.classify(no_documents, odd).count() == 0


def test_scores_never_see_labels_of_the_fold(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: round(r["score"], 9) for r in quality.classify(docs, labels).collect()}
    assert a == {r["doc_id"]: round(r["score"], 9) for r in quality.classify(docs, flipped).collect()}


def test_toxicity_finds_toxic_rows(spark):
    docs, labels, rows = labelled(spark)
    train = labels.where("doc_id % 2 = 0")
    got = {r["doc_id"]: r for r in toxicity.severity(docs.withColumn("grade", F.lit(9)), train).collect()}
    test = [r for r in rows if r[0] % 2]
    assert not any(got[i]["toxic"] for i, _, _, t in test if not t)
    assert np.mean([got[i]["toxic"] for i, _, _, t in test if t]) > 0.9
    assert all(0 <= r["severity"] <= toxicity.GRADES - 1 for r in got.values())


def test_thresholds_rise_and_weights_are_shared():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (600, 4)).astype(float)
    grade = np.digitize(x @ [1.0, 2.0, 0.0, -1.0] + rng.logistic(size=600) * 0.3, [1, 3])
    row, term = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(toxicity.Rows(row, term, x[row, term], grade, np.ones(600)), 4, 3)
    assert (np.diff(cuts) > 0).all() and w[1] > w[0] > abs(w[2]) and w[3] < 0


def test_toxicity_edge_cases(spark, documents, no_documents):
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r["severity"] for r in toxicity.severity(documents, one).collect()} == {0.0}
    odd = spark.createDataFrame([(1, None), (None, 1), (77_777, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.severity(documents, odd).count() == documents.count()
    assert toxicity.severity(no_documents, odd).count() == 0


def test_rows_of_one_id_are_judged_each(spark):
    docs, labels, rows = labelled(spark)
    fine = next(t for _, t, q, x in rows if q and not x)
    poor, toxic = next(t for _, t, q, _ in rows if not q), next(t for _, t, _, x in rows if x)
    for keep, wrong in ((quality.keep_good, poor), (toxicity.keep_civil, toxic)):
        pairs = [(i, t) for i in (None, 9001) for t in (fine, wrong)] * 2
        more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(pairs, "doc_id long, text string"))
        more = more.withColumns({c: F.lit("own") for c in ("key_a", "score", "doc", "toxic")})
        kept = keep(more, labels)
        assert kept.columns == more.columns
        got = [(r["doc_id"], r["text"]) for r in kept.where("doc_id IS NULL OR doc_id = 9001").collect()]
        assert sorted(got, key=str) == sorted([(None, fine), (9001, fine)] * 2, key=str)


def test_pipeline_stages(spark, tmp_path):
    docs, labels, rows = labelled(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en", "s", len(t)) for i, t, _, _ in rows] + [(9000, rows[1][1], "en", "s", 1), (9001, rows[1][1] + " ", "en", "s", 1), (9002, None, None, None, None)]
    spark.createDataFrame(full, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, got, str(tmp_path))
        assert after.columns == got.columns, name
        got = after.persist()
        left.append({r["doc_id"] for r in got.select("doc_id").collect()})
    good = {i for i, _, q, _ in rows if q}
    civil = {i for i, _, _, t in rows if not t}
    assert len(good - left[0]) <= 5 and len((left[0] - good) & set(range(400))) <= 5
    assert left[0] & civil <= left[1] | {9002} and not left[1] & (set(range(400)) - civil)
    assert 1 in left[2] and not {9000, 9001} & left[2]
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert packed == left[2]


def test_keep_one_of_nothing(no_documents):
    assert simhash_dedup.keep_one(no_documents).count() == 0


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()) == list(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
