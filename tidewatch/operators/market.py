"""Trailing features of daily series. Every statistic leaves its own day out and
looks back over calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.stats import TINY, only_if, standard_score, trailing_days

WINDOW_DAYS, MIN_HISTORY = 30, 20
FEATURES = (
    "return_z",
    "volume_z",
    "turnover_z",
    "market_corr",
    "market_beta",
    "residual_return",
    "residual_z",
    "volume_price_gap",
)


def market_return(rows: DataFrame) -> DataFrame:
    """Median return of the entities' ordinary moves, by date."""
    ordinary = rows.where(F.col("log_return").isNotNull() & ~F.col("extreme_move"))
    return ordinary.groupBy("date").agg(F.median("log_return").alias("market_return"))


def without_gap_returns(rows: DataFrame) -> DataFrame:
    """A return over missing days is no daily return."""
    daily = F.coalesce(F.col("missing_days_before"), F.lit(0)) == 0
    return rows.withColumn("log_return", only_if(daily, F.col("log_return")))


def market_features(rows: DataFrame, *, window_days: int = WINDOW_DAYS, min_history: int = MIN_HISTORY) -> DataFrame:
    """One row for each of rows. Moments of (return, market return) are those of
    days on which the return is known; a date without market return leaves its
    products out. All features wait for min_history returns."""
    daily = without_gap_returns(rows)
    joined = daily.join(market_return(daily), "date", "left")
    past = trailing_days("coin_id", "date", window_days)

    r = F.col("log_return")
    m = only_if(r.isNotNull(), F.col("market_return"))
    traded = (F.col("market_cap") > 0) & (F.col("volume") > 0)
    joined = joined.withColumns(
        {"_lv": F.log1p("volume"), "_lt": only_if(traded, F.ln(F.col("volume") / F.col("market_cap"))), "_m": m}
    )
    mean = lambda c: F.avg(c).over(past)
    moments = joined.withColumns(
        {
            "n_history": F.count(r).over(past),
            "_spread": F.stddev_samp(r).over(past),
            "_cov": mean(r * F.col("_m")) - mean(r) * mean(F.col("_m")),
            "_var_r": mean(r * r) - mean(r) * mean(r),
            "_var_m": mean(F.col("_m") * F.col("_m")) - mean(F.col("_m")) * mean(F.col("_m")),
            "return_z": standard_score(r, past),
            "volume_z": standard_score(F.col("_lv"), past),
            "turnover_z": standard_score(F.col("_lt"), past),
        }
    )
    known = moments.withColumns(
        {
            "market_corr": only_if(
                (F.col("_var_r") > TINY) & (F.col("_var_m") > TINY), F.col("_cov") / F.sqrt(F.col("_var_r") * F.col("_var_m"))
            ),
            "market_beta": only_if(F.col("_var_m") > TINY, F.col("_cov") / F.col("_var_m")),
            "volume_price_gap": F.col("volume_z") - F.abs("return_z"),
        }
    )
    own = F.col("_spread") * F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("market_corr") * F.col("market_corr")))
    residual = r - F.col("market_beta") * F.col("market_return")
    full = known.withColumn("residual_return", residual).withColumn("residual_z", only_if(own > TINY, residual / own))
    ready = F.col("n_history") >= min_history
    return full.select(
        "coin_id",
        "date",
        "price",
        "market_cap",
        "volume",
        "log_return",
        "extreme_move",
        "market_return",
        "n_history",
        *[only_if(ready, F.col(c)).alias(c) for c in FEATURES],
    )
