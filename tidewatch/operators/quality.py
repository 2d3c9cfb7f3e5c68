"""Daily series: quality flags, a verdict for each entity, the clean view."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

JUMP = math.log(10)  # a day-over-day move beyond ten times
COLLAPSE = 0.05  # of both neighbours' volume
STALE_SHARE = 0.2
MOST_JUMPS = 1


def flag_daily(raw: DataFrame) -> DataFrame:
    """raw with prev_price, log_return, extreme_move, zero_volume, volume_glitch
    and missing_days_before. Neighbours are adjacent rows of the entity. Where
    exactly one of two prices is zero the move is infinite: extreme, with a null
    return."""
    by_day = W.partitionBy("coin_id").orderBy("date")
    beside = raw.select(
        "coin_id",
        "date",
        "price",
        "market_cap",
        "volume",
        F.lag("price").over(by_day).alias("prev_price"),
        F.lag("volume").over(by_day).alias("_volume_before"),
        F.lead("volume").over(by_day).alias("_volume_after"),
        F.lag("date").over(by_day).alias("_date_before"),
    )
    both = (F.col("price") > 0) & (F.col("prev_price") > 0)
    move = F.when(both, F.ln(F.col("price") / F.col("prev_price")))
    infinite = (F.col("price") == 0) != (F.col("prev_price") == 0)
    collapsed = (F.col("volume") < COLLAPSE * F.col("_volume_before")) & (F.col("volume") < COLLAPSE * F.col("_volume_after"))
    return beside.select(
        "coin_id",
        "date",
        "price",
        "market_cap",
        "volume",
        "prev_price",
        move.alias("log_return"),
        _sure(F.coalesce(F.abs(move) > JUMP, infinite)).alias("extreme_move"),
        (F.col("volume") == 0).alias("zero_volume"),
        _sure(collapsed).alias("volume_glitch"),
        (F.date_diff("date", "_date_before") - 1).alias("missing_days_before"),
    )


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def verdicts(flagged: DataFrame) -> DataFrame:
    """One row per entity: counts, span, gaps and status, which is feed_glitch
    before stale_feed before ok."""
    counted = flagged.groupBy("coin_id").agg(
        F.count("*").alias("days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if("extreme_move").alias("extreme_moves"),
        F.count_if("zero_volume").alias("zero_volume_days"),
        F.count_if("volume_glitch").alias("volume_glitch_days"),
    )
    status = (
        F.when(F.col("extreme_moves") > MOST_JUMPS, "feed_glitch")
        .when(F.col("zero_volume_days") / F.col("days") > STALE_SHARE, "stale_feed")
        .otherwise("ok")
    )
    span = F.date_diff("last_date", "first_date") + 1
    return counted.withColumn("missing_days", (span - F.col("days")).cast("long")).withColumn("status", status)


def clean(flagged: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Rows of entities with an ok verdict, without isolated volume collapses."""
    quality = verdicts(flagged) if quality is None else quality
    good = quality.where(F.col("status") == "ok").select("coin_id")
    return flagged.join(good, "coin_id", "left_semi").where(~F.col("volume_glitch"))


def pegged(clean_rows: DataFrame, *, below: float = 0.002) -> DataFrame:
    """Entities whose median absolute return is that of a peg."""
    typical = clean_rows.groupBy("coin_id").agg(F.median(F.abs("log_return")).alias("typical_move"))
    return typical.where(F.col("typical_move") < below)


def impossible_turnover(clean_rows: DataFrame, *, times: float, flat: float = 0.05) -> DataFrame:
    """Rows that trade more than `times` their market cap at a flat price, pegs
    aside. A null in the peg list cannot hide rows: ids there are never null."""
    odd = clean_rows.where(
        (F.col("market_cap") > 0)
        & (F.col("volume") > times * F.col("market_cap"))
        & (F.abs(F.exp("log_return") - 1) < flat)
    )
    return odd.join(pegged(clean_rows).select("coin_id"), "coin_id", "left_anti").withColumn(
        "turnover", F.col("volume") / F.col("market_cap")
    )
