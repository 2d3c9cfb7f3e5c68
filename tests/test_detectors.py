"""Detectors, flags, comparison, evaluation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import compare, detectors, evaluation


def frame(spark, x):
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "k int, " + ", ".join(f"f{j} double" for j in range(np.shape(x)[1])))


def test_zscore_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0, -5.0), (None, 2.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(detectors.zscore_score(["a", "b"])).collect()] == [5.0, 2.0, None]


def test_forest_ranks_the_outlier_first_and_is_repeatable(spark):
    x = np.random.default_rng(0).normal(size=(300, 2))
    x[17] = (9, -9)
    score = lambda n: detectors.isolation_forest_score(frame(spark, x).repartition(n), ["k"], ["f0", "f1"], trees=40)
    a = {r["k"]: r["iforest_score"] for r in score(3).collect()}
    assert max(a, key=a.get) == 17
    assert a == {r["k"]: r["iforest_score"] for r in score(5).collect()}


def brute_lof(points, k):
    u = np.unique(np.round(points, 1), axis=0)
    d = np.round(np.sqrt(((u[:, None] - u[None]) ** 2).sum(-1)), 9)
    np.fill_diagonal(d, np.inf)
    return u, d


def test_lof_equals_brute_force_without_ties(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(160, 3)) * 40, 1)
    k = 7
    u, d = brute_lof(x, k)
    near = np.argsort(d, axis=1)[:, :k]
    kd = np.sort(d, axis=1)[:, k - 1]
    reach = np.maximum(kd[near], np.take_along_axis(d, near, 1))
    density = 1 / (reach.mean(1) + 1e-10)
    want = {tuple(p): v for p, v in zip(u, density[near].mean(1) / density, strict=True)}
    got = detectors.lof_score(frame(spark, x), ["f0", "f1", "f2"], n_neighbors=k).collect()
    ties = np.sort(d, axis=1)
    clear = {tuple(p) for p, t in zip(u, ties, strict=True) if t[k - 1] < t[k]}
    hit = [(r["lof_score"], want[(r["f0"], r["f1"], r["f2"])]) for r in got if (r["f0"], r["f1"], r["f2"]) in clear]
    assert len(hit) > 100 and np.median([abs(a - b) for a, b in hit]) < 1e-6


def test_lof_of_copies_and_of_one_point(spark):
    same = detectors.lof_score(frame(spark, [[0.0, 0.0]] * 20), ["f0", "f1"]).collect()
    assert {r["lof_score"] for r in same} == {1.0}
    many = np.vstack([np.zeros((300, 2)), np.random.default_rng(1).normal(size=(60, 2)), [[30, 30]]])
    got = {r["k"]: r["lof_score"] for r in detectors.lof_score(frame(spark, many), ["f0", "f1"]).collect()}
    assert max(got, key=got.get) == 360 and len({got[i] for i in range(300)}) == 1


def test_neighbours_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(detectors, "BLOCK", 16)
    x = np.random.default_rng(5).normal(size=(100, 2))
    points = frame(spark, x).select(F.col("k").cast("long").alias("id"), F.col("f0").alias("x0"), F.col("f1").alias("x1"))
    got = {}
    for r in detectors.nearest_neighbors(points, 2, 4).collect():
        got.setdefault(r["id"], set()).add(r["other"])
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    np.fill_diagonal(d, np.inf)
    assert got == {i: set(np.argsort(d[i])[:4].tolist()) for i in range(100)}


@pytest.mark.parametrize("scores,rate,want", [([1, 5, 5, 5, 2], 0.4, {1, 2}), ([3, 1, 2], 0.0, {0}), ([1] * 5, 0.5, {0, 1}), ([2, 1], 1.0, {0, 1})])
def test_flag_top_flags_exactly_the_budget(spark, scores, rate, want):
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "k int, s double")
    got = detectors.flag_top(df, "s", ["k"], rate=rate, out="f")
    assert {r["k"] for r in got.where("f").collect()} == want


def test_flag_top_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, s double")
    assert detectors.flag_top(df, "s", ["k"], rate=0.1, out="f").count() == 0


def test_kinds_are_strict_and_ordered(spark):
    rows = [(4.0, 4.0, 0.0), (4.0, 3.0, 9.0), (3.0, -4.0, 9.0), (0.0, 0.0, 4.0), (3.0, 3.0, 3.0), (None, None, None)]
    df = spark.createDataFrame(rows, "p double, v double, o double")
    got = [r[0] for r in df.select(compare.anomaly_type(F.col("p"), F.col("v"), F.col("o"))).collect()]
    assert got == ["price_and_vol", "price_shock", "volume_only", "other_feature", "multivariate", "multivariate"]


def test_agreement_of_nothing_is_one(spark):
    df = spark.createDataFrame([(False, False), (False, False)], "a_flag boolean, b_flag boolean")
    assert {r["jaccard"] for r in compare.agreement(df, ["a", "b"]).collect()} == {1.0}


def history(spark, coins=6, n=60):
    rng = np.random.default_rng(2)
    rows = [
        (f"c{c}", dt.date(2026, 1, 1) + dt.timedelta(days=i), float(rng.normal(0, 0.02)), float(np.exp(rng.normal(10, 0.3))), 1e6)
        for c in range(coins)
        for i in range(n)
    ]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["coin_id", "date", "log_return", "volume", "market_cap"]))
    return df.withColumn("residual_return", F.col("log_return"))


def test_sites_are_balanced_and_late_enough(spark):
    df = history(spark)
    sites = evaluation.choose_sites(df).collect()
    assert len(sites) == 6 and sorted(s["type"] for s in sites) == sorted(list(evaluation.TYPES) * 2)
    assert all((s["date"] - dt.date(2026, 1, 1)).days >= 40 for s in sites)
    assert evaluation.choose_sites(history(spark, n=41)).count() == 0


def test_injection_touches_only_its_rows(spark):
    df = history(spark)
    sites = evaluation.choose_sites(df)
    after = evaluation.inject(df, sites, 12.0).withColumnsRenamed({c: f"n_{c}" for c in ("log_return", "volume", "market_cap", "residual_return")})
    rows = df.join(after, ["coin_id", "date"]).join(sites, ["coin_id", "date"], "left").orderBy("date").toPandas()
    at = rows.type.notna()
    assert (rows.log_return[~at] == rows.n_log_return[~at]).all() and (rows.volume[~at] == rows.n_volume[~at]).all()
    for s in rows[at].itertuples():
        later = rows[(rows.coin_id == s.coin_id) & (rows.date > s.date)]
        moved = not np.isclose(later.n_market_cap, later.market_cap).all() if len(later) else s.type != "volume_spike"
        assert moved == (s.type != "volume_spike")
        assert (s.n_volume > s.volume) == (s.type == "volume_spike")


def test_recall_and_hits(spark):
    day = dt.date(2026, 1, 5)
    scored = spark.createDataFrame(
        [("a", day, True, 2, 9.0, 5.0, 1.0), ("b", day, False, 0, 1.0, 0.0, 0.0)],
        "coin_id string, date date, z_flag boolean, votes int, z_score double, rz_return double, rz_volume double",
    )
    sites = spark.createDataFrame([("a", day, "combo", 1.0), ("gone", day, "combo", 1.0)], "coin_id string, date date, type string, sign double")
    got = {r["type"]: (r["sites"], r["z"], r["consensus_2plus"]) for r in evaluation.recall(scored, sites, methods=["z"]).collect()}
    assert got == {"combo": (1, 1.0, 1.0), "all": (1, 1.0, 1.0)}
    assert evaluation.precision_at_k(scored, sites, methods=["z"]).first()["z"] == 1.0
    events = evaluation.events_frame(spark, [("hit", "a", "2026-01-06"), ("no data", "x", "2026-01-06")])
    hits = {r["event"]: (r["rows"], r["z"], r["max_abs_rz_return"]) for r in evaluation.window_hits(scored, events, methods=["z"]).collect()}
    assert hits == {"hit": (1, True, 5.0), "no data": (0, False, None)}


def test_flags_among_many_ties_and_nulls(spark):
    rows = [(f"k{i:04d}", 1.0 if i % 3 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, s double").repartition(7)
    got = {r["k"] for r in detectors.flag_top(df, "s", ["k"], k=250, out="f").where("f").collect()}
    assert got == {k for k, _ in sorted(r for r in rows if r[1])[:250]}
    assert detectors.flag_top(df, "s", ["k"], k=5000, out="f").where("f").count() == 600


def test_meetings_are_all_boxes_within_reach(spark):
    rng = np.random.default_rng(8)
    rows = []
    for b in range(60):
        low = rng.normal(size=3) * 3
        rows.append((b, low.tolist(), (low + rng.random(3)).tolist(), float(rng.random() * (30 if b == 7 else 1))))
    df = spark.createDataFrame(rows, "b long, low array<double>, high array<double>, most double")
    want = set()
    for b, low, high, most in rows:
        for c, low2, high2, _ in rows:
            apart = np.maximum(0, np.maximum(np.array(low2) - high, np.array(low) - high2))
            if np.sqrt((apart**2).sum()) <= most + 1e-8:
                want.add((b, c))
    assert {tuple(r) for r in detectors._meetings(df, 3).collect()} == want


def test_reports_as_documents(spark):
    from tidewatch.operators import reports

    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None)], "k string, n int, x double")
    body = {r["item"]: r["body"] for r in reports.documents({"s": (df, ["k"])}).collect()}
    assert body == {"a": '{"k":"a","n":1,"x":0.5}', "b": '{"k":"b","n":2}'}
    assert {(r["item"], r["field"]): r["value"] for r in reports.figures({"s": (df, ["k"])}).collect()} == {("a", "n"): 1.0, ("a", "x"): 0.5, ("b", "n"): 2.0, ("b", "x"): None}
