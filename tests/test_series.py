"""Daily series: flags, verdicts, trailing features, robust scores."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import stats
from tidewatch.operators import market, quality, robust, selection

DAY = dt.date(2026, 1, 1)


def days(n):
    return [DAY + dt.timedelta(days=i) for i in range(n)]


def raw(spark, rows):
    return spark.createDataFrame(rows, "coin_id string, date date, price double, market_cap double, volume double")


def flat(spark, coin="a", n=6, volume=100.0):
    return [(coin, d, 1.0, 1000.0, volume) for d in days(n)]


def test_first_row_has_no_move_and_no_gap(spark):
    first = quality.flag_daily(raw(spark, flat(spark))).orderBy("date").first()
    assert first["log_return"] is None and first["extreme_move"] is False and first["missing_days_before"] is None


def test_collapse_is_a_glitch_but_a_spike_is_not(spark):
    rows = flat(spark)
    rows[2] = ("a", rows[2][1], 1.0, 1000.0, 1.0)
    rows[4] = ("a", rows[4][1], 1.0, 1000.0, 1e6)
    got = {r["date"]: r["volume_glitch"] for r in quality.flag_daily(raw(spark, rows)).collect()}
    assert [d for d, g in got.items() if g] == [rows[2][1]]


def test_zero_price_is_extreme_without_a_return(spark):
    rows = flat(spark)
    rows[3] = ("a", rows[3][1], 0.0, 1000.0, 100.0)
    got = quality.flag_daily(raw(spark, rows)).orderBy("date").collect()
    assert got[3]["extreme_move"] and got[3]["log_return"] is None and got[4]["extreme_move"]


@pytest.mark.parametrize("zero_days,status", [(1, "ok"), (2, "stale_feed")])
def test_stale_share_is_strict(spark, zero_days, status):
    rows = [("a", d, 1.0, 1000.0, 0.0 if i < zero_days else 100.0) for i, d in enumerate(days(5))]
    assert quality.verdicts(quality.flag_daily(raw(spark, rows))).first()["status"] == status


def test_two_jumps_beat_staleness(spark):
    rows = [("a", d, (1.0, 20.0, 1.0)[i % 3] if i < 3 else 1.0, 1.0, 0.0) for i, d in enumerate(days(5))]
    got = quality.verdicts(quality.flag_daily(raw(spark, rows))).first()
    assert got["status"] == "feed_glitch" and got["extreme_moves"] == 2


def test_clean_drops_bad_coins_and_glitches(spark):
    rows = flat(spark, "a") + [("b", d, (1.0, 20.0)[i % 2], 1.0, 5.0) for i, d in enumerate(days(6))]
    rows[2] = ("a", rows[2][1], 1.0, 1000.0, 1.0)
    clean = quality.clean(quality.flag_daily(raw(spark, rows)))
    assert {(r["coin_id"]) for r in clean.collect()} == {"a"} and clean.count() == 5


def features_input(spark, values, coin="a", gaps=()):
    rows = [
        (coin, d, 1.0, 1000.0, 100.0, v, False, 1 if i in gaps else 0) for i, (d, v) in enumerate(zip(days(len(values)), values))
    ]
    return spark.createDataFrame(
        rows,
        "coin_id string, date date, price double, market_cap double, volume double, log_return double, extreme_move boolean, missing_days_before int",
    )


def test_market_return_is_a_median_of_ordinary_moves(spark):
    df = features_input(spark, [0.01], "a").union(features_input(spark, [0.02], "b")).union(features_input(spark, [0.3], "c"))
    assert market.market_return(df).first()["market_return"] == 0.02


def test_own_day_is_left_out(spark):
    values = [0.01 * (-1) ** i for i in range(25)] + [5.0]
    last = market.market_features(features_input(spark, values)).orderBy(F.desc("date")).first()
    past = values[:25]
    assert last["n_history"] == 25
    assert last["return_z"] == pytest.approx((5.0 - statistics.mean(past)) / statistics.stdev(past))


def test_gap_returns_are_no_history(spark):
    got = market.market_features(features_input(spark, [0.01] * 22, gaps=(3, 4))).orderBy(F.desc("date")).first()
    assert got["n_history"] == 19 and got["market_beta"] is None


def test_robust_score_has_a_floor_and_waits(spark):
    values = [0.0] * 20 + [0.05]
    rows = features_input(spark, values).withColumn("residual_return", F.col("log_return"))
    got = robust.robust_market_features(rows).orderBy("date").collect()
    assert got[19]["rz_return"] is None and got[20]["rz_return"] == pytest.approx(0.05 / 0.005)


def test_robust_score_equals_brute_force(spark):
    values = [math.sin(i * i) for i in range(40)]
    rows = features_input(spark, values).withColumn("residual_return", F.col("log_return"))
    got = [r["rz_return"] for r in robust.robust_market_features(rows).orderBy("date").collect()]
    for i, v in enumerate(values):
        past = values[max(0, i - 30) : i]
        if len(past) < 20:
            assert got[i] is None
            continue
        m = statistics.median(past)
        mad = 1.4826 * statistics.median(abs(x - m) for x in past)
        assert got[i] == pytest.approx((v - m) / max(mad, 0.005))


def test_exact_quantile_takes_the_upper_middle(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert selection.exact_quantiles(df.withColumn("g", F.lit(1)), ["g"], "x", {"m": 0.5}).first()["m"] == 2.0


def test_very_large_integers_sum_exactly(spark):
    values = [10**77 + 7, 10**77 + 5, 3]
    df = spark.createDataFrame([(str(v),) for v in values], "v string")
    assert stats.join_limbs(list(df.agg(*stats.limb_sums(F.col("v"))).first())) == str(sum(values))


def test_significant_digits(spark):
    df = spark.createDataFrame([(123456.0,), (None,), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(stats.significant(F.col("x"), 3)).collect()] == [123000.0, None, None]
