"""Comparison of detectors: kinds of anomaly, agreement, what only one finds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import detectors
from tidewatch.operators.scoring import METHODS

EXTREME = 3.0
KINDS = ("volume_only", "price_and_vol", "price_shock", "other_feature", "multivariate")


def anomaly_type(price: Column, volume: Column, other: Column, *, extreme: float = EXTREME) -> Column:
    p, v, o = (F.coalesce(F.abs(c) > extreme, F.lit(False)) for c in (price, volume, other))
    return (
        F.when(p & v, "price_and_vol").when(p, "price_shock").when(v, "volume_only").when(o, "other_feature").otherwise("multivariate")
    )


def with_type(scored: DataFrame) -> DataFrame:
    other = F.greatest(F.abs("rz_turnover"), F.abs("rz_residual"))
    return scored.withColumn("type", anomaly_type(F.col("rz_return"), F.col("rz_volume"), other))


def jaccard(a: Column, b: Column) -> Column:
    """Aggregate: share of the union that both flag, 1 if none is flagged."""
    union = F.count_if(a | b)
    return F.when(union == 0, F.lit(1.0)).otherwise(F.try_divide(F.count_if(a & b), union))


def agreement(scored: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """(a, b, jaccard) of every ordered pair of methods, from one pass."""
    pairs = [(a, b) for a in methods for b in methods]
    row = scored.agg(*[jaccard(F.col(f"{a}_flag"), F.col(f"{b}_flag")).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("jaccard")) for a, b in pairs])
    return row.select(F.inline(cells))


def method_mix(typed: DataFrame, methods: Sequence[str] = METHODS, *, calm: float = 1.0) -> DataFrame:
    """For each method: flags, flags of its own, shares of kinds and of days on
    which no robust feature moves."""
    quiet = F.greatest(*[F.abs(c) for c in ("rz_return", "rz_volume", "rz_turnover", "rz_residual")]) < calm
    cells = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"{m}_flag").alias("flag")) for m in methods])
    long = typed.select("type", "votes", quiet.alias("quiet"), F.inline(cells)).where("flag")
    return long.groupBy("method").agg(
        F.count("*").alias("flags"),
        F.count_if(F.col("votes") == 1).alias("alone"),
        F.avg(F.col("quiet").cast("double")).alias("calm_share"),
        *[F.avg((F.col("type") == k).cast("double")).alias(k) for k in KINDS],
    )


def wash_candidates(typed: DataFrame) -> DataFrame:
    """Days that most methods flag for volume alone."""
    return typed.where((F.col("votes") >= 2) & (F.col("type") == "volume_only") & (F.col("rz_volume") > 0))


def strongest_agreed(typed: DataFrame, *, most: int = 400) -> DataFrame:
    agreed = typed.where(F.col("votes") >= 2)
    return agreed.orderBy(F.desc("votes"), F.desc("volume"), "coin_id", "date").limit(most)


def standard_against_robust(scored: DataFrame, *, budget: float, key: Sequence[str] = ("coin_id", "date")) -> DataFrame:
    """One row: how far mean/deviation scores and median/MAD scores agree at one
    budget, and how many standard flags no robust feature supports."""
    standard = [F.coalesce(F.abs(c), F.lit(0.0)) for c in ("return_z", "volume_z", "turnover_z", "residual_z")]
    robust = F.greatest(*[F.abs(c) for c in ("rz_return", "rz_volume", "rz_turnover", "rz_residual")])
    rows = scored.withColumns({"_s": F.greatest(*standard), "_r": robust})
    rows = detectors.flag_top(rows, "_s", list(key), rate=budget, out="_standard")
    return rows.agg(
        jaccard(F.col("_standard"), F.col("zscore_flag")).alias("overlap"),
        F.count_if("_standard").alias("standard_flags"),
        F.count_if(F.col("_standard") & (F.col("_r") < EXTREME)).alias("blowups"),
        F.max("_s").alias("max_standard"),
        F.max("_r").alias("max_robust"),
    )


def busiest_day(rows: DataFrame) -> DataFrame:
    """Each entity's day of largest volume."""
    rest = [c for c in rows.columns if c != "coin_id"]
    best = F.max_by(F.struct(*rest), F.struct("volume", F.datediff(F.lit("9999-12-31"), "date")))
    return rows.groupBy("coin_id").agg(best.alias("_b")).select("coin_id", "_b.*")


def strongest_feature(rows: DataFrame, features: Sequence[str]) -> Column:
    """The feature of largest magnitude, the first of equals; nulls count as 0."""
    cells = [F.struct(F.coalesce(F.abs(c), F.lit(0.0)).alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("name")) for i, c in enumerate(features)]
    return F.array_max(F.array(*cells))["name"]


def kept_moves(scored: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """Of the single extreme moves that cleaning kept, how many each method flags."""
    kept = scored.where("extreme_move")
    return kept.agg(F.count("*").alias("kept"), *[F.count_if(f"{m}_flag").alias(m) for m in methods])


def consensus(scored: DataFrame) -> DataFrame:
    """Rows by number of votes."""
    return scored.groupBy("votes").agg(F.count("*").alias("rows"))
