"""Robust trailing scores: distance from the median in units of the scaled
median absolute deviation, which has a floor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.stats import let, middle, only_if, scaled_deviation, trailing_days

RETURN_FLOOR, VOLUME_FLOOR = 0.005, 0.10
FEATURES = ("rz_return", "rz_volume", "rz_turnover", "rz_residual")


def robust_z(rows: DataFrame, sources: dict[str, tuple[Column, float]], over: WindowSpec, *, min_periods: int = 20) -> DataFrame:
    """rows with a score for each source (name -> value, floor), from one pass
    over the window. Its values are a bounded array for each row (a calendar
    window of d days holds at most d rows); nulls don't count."""
    held = rows.withColumns({f"_x_{out}": value for out, (value, _) in sources.items()})
    held = held.withColumns({f"_w_{out}": F.collect_list(f"_x_{out}").over(over) for out in sources})

    def score(out: str, floor: float) -> Column:
        x, known = F.col(f"_x_{out}"), F.col(f"_w_{out}")
        ratio = let(
            F.array_sort(known),
            lambda w: let(middle(w), lambda c: (x - c) / F.greatest(scaled_deviation(w, c), F.lit(floor))),
        )
        return only_if(F.size(known) >= min_periods, ratio)

    scored = held.withColumns({out: score(out, floor) for out, (_, floor) in sources.items()})
    return scored.drop(*[f"_{k}_{out}" for k in "xw" for out in sources])


def robust_market_features(rows: DataFrame, *, window_days: int = 30, min_periods: int = 20) -> DataFrame:
    """rows with the four robust scores. Each waits for its own observations."""
    past = trailing_days("coin_id", "date", window_days)
    traded = (F.col("market_cap") > 0) & (F.col("volume") > 0)
    sources = {
        "rz_return": (F.col("log_return"), RETURN_FLOOR),
        "rz_volume": (F.log1p("volume"), VOLUME_FLOOR),
        "rz_turnover": (only_if(traded, F.ln(F.col("volume") / F.col("market_cap"))), VOLUME_FLOOR),
        "rz_residual": (F.col("residual_return"), RETURN_FLOOR),
    }
    return robust_z(rows, sources, past, min_periods=min_periods)


def robust_series(rows: DataFrame, *, value: str, date: str = "date", floor: float, out: str = "z", window_days: int = 30) -> DataFrame:
    """The score of one series (a row a day, so at most as many rows as days)."""
    named = rows.withColumn("_one", F.lit(1))
    return robust_z(named, {out: (F.col(value), floor)}, trailing_days("_one", date, window_days)).drop("_one")


def trailing_scale(value: Column, entity: str, order: str, *, rows: int = 30, floor: float) -> Column:
    """Scaled deviation of the last rows before each, its floor if there are none."""
    before = W.partitionBy(entity).orderBy(order).rowsBetween(-rows, -1)
    spread = let(F.array_sort(F.collect_list(value).over(before)), lambda w: let(middle(w), lambda c: scaled_deviation(w, c)))
    return F.coalesce(F.greatest(spread, F.lit(floor)), F.lit(floor))
