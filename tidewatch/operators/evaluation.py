"""Planted anomalies: sites, injection, recall and precision; event backtests.

Sites follow from hashes of the entity and a seed, so a run is the same on any
engine and partitioning. Types go round the sites in hash order, so they are
balanced."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators import detectors
from tidewatch.operators.robust import RETURN_FLOOR, VOLUME_FLOOR, trailing_scale
from tidewatch.operators.scoring import METHODS
from tidewatch.operators.selection import ranked

TYPES = ("price_spike", "volume_spike", "combo")
LEAST_HISTORY = 40
STRENGTHS = (3.0, 6.0, 12.0, 24.0)
SEED = 2026


def _draw(seed: int, name: str, *parts: str) -> Column:
    """A number below 2^31 that depends on the parts: the first eight digits of
    an MD5, which every engine has."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[F.col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def choose_sites(rows: DataFrame, *, seed: int = SEED, least: int = LEAST_HISTORY) -> DataFrame:
    """(coin_id, date, type, sign): one site for each entity of more than
    least+1 rows, at or after its row number `least` (from 0)."""
    sizes = rows.groupBy("coin_id").agg(F.count("*").alias("_n")).where(F.col("_n") > least + 1)
    picked = sizes.select("coin_id", (least + _draw(seed, "row", "coin_id") % (F.col("_n") - least)).alias("_at"))
    picked = ranked(picked, [_draw(seed, "turn", "coin_id"), F.col("coin_id")], "_turn")
    kinds = F.array(*map(F.lit, TYPES))
    picked = picked.withColumn("type", kinds[((F.col("_turn") - 1) % len(TYPES)).cast("int")]).drop("_turn")
    picked = picked.withColumn("sign", F.when(_draw(seed, "sign", "coin_id") % 2 == 0, 1.0).otherwise(-1.0))
    numbered = rows.select("coin_id", "date", (F.row_number().over(W.partitionBy("coin_id").orderBy("date")) - 1).alias("_at"))
    return numbered.join(picked, ["coin_id", "_at"]).select("coin_id", "date", "type", "sign")


def inject(rows: DataFrame, sites: DataFrame, strength: float) -> DataFrame:
    """rows with one anomaly at each site, in units of the entity's own trailing
    scale. A price move stays in the market cap from that day on."""
    scale_r = trailing_scale(F.col("log_return"), "coin_id", "date", floor=RETURN_FLOOR)
    scale_v = trailing_scale(F.log1p("volume"), "coin_id", "date", floor=VOLUME_FLOOR)
    held = rows.withColumns({"_sr": scale_r, "_sv": scale_v}).join(sites, ["coin_id", "date"], "left")
    part = F.when(F.col("type") == "price_spike", 1.0).when(F.col("type") == "combo", 0.5)
    shift = F.coalesce(F.col("sign") * strength * F.col("_sr") * part, F.lit(0.0))
    swell = F.when(F.col("type") == "volume_spike", strength * F.col("_sv")).when(
        F.col("type") == "combo", -0.5 * strength * F.col("_sv")
    )
    so_far = W.partitionBy("coin_id").orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    held = held.withColumns({"_shift": shift, "_swell": F.coalesce(swell, F.lit(0.0))})
    return held.withColumns(
        {
            "log_return": F.col("log_return") + F.col("_shift"),
            "residual_return": F.col("residual_return") + F.col("_shift"),
            "market_cap": F.col("market_cap") * F.exp(F.sum("_shift").over(so_far)),
            "volume": F.when(F.col("_swell") == 0, F.col("volume")).otherwise(F.col("volume") * F.exp("_swell")),
        }
    ).select(*rows.columns)


def recall(scored: DataFrame, sites: DataFrame, *, methods: Sequence[str] = METHODS) -> DataFrame:
    """Share of sites that each method flags, by type and over all; sites that
    are no model row don't count."""
    hit = sites.join(scored, ["coin_id", "date"])
    shares = [F.avg(F.col(f"{m}_flag").cast("double")).alias(m) for m in methods]
    shares.append(F.avg((F.col("votes") >= 2).cast("double")).alias("consensus_2plus"))
    return hit.rollup("type").agg(F.count("*").alias("sites"), *shares).withColumn("type", F.coalesce("type", F.lit("all")))


def precision_at_k(scored: DataFrame, sites: DataFrame, *, methods: Sequence[str] = METHODS) -> DataFrame:
    """Of each method's k highest scores, k the number of sites, the share that
    are sites."""
    marked = scored.join(sites.select("coin_id", "date", F.lit(True).alias("_site")), ["coin_id", "date"], "left")
    k = scored.join(sites, ["coin_id", "date"], "left_semi").count()
    for m in methods:
        marked = detectors.flag_top(marked, f"{m}_score", ["coin_id", "date"], k=max(1, k), out=f"_{m}")
    site = F.coalesce("_site", F.lit(False))
    return marked.agg(*[F.try_divide(F.count_if(F.col(f"_{m}") & site), F.count_if(f"_{m}")).alias(m) for m in methods])


def event_rows(chart: DataFrame, market_return: DataFrame) -> DataFrame:
    """Rows of an appended entity like those of the features: the return only
    from one day to the next, the residual at a beta of one."""
    by_day = W.partitionBy("coin_id").orderBy("date")
    next_day = F.date_diff("date", F.lag("date").over(by_day)) == 1
    before = F.lag("price").over(by_day)
    move = F.when(next_day & (before > 0) & (F.col("price") > 0), F.ln(F.col("price") / before))
    joined = chart.withColumn("log_return", move).join(market_return, "date", "left")
    return joined.select(
        "coin_id", "date", "volume", "market_cap", "log_return", (F.col("log_return") - F.col("market_return")).alias("residual_return")
    )


def window_hits(scored: DataFrame, events: DataFrame, *, days: int = 1, methods: Sequence[str] = METHODS) -> DataFrame:
    """For each event (event, coin_id, event_date): rows within the days around
    it, whether each method flags one, peak scores. No rows is no data, not a miss."""
    near = scored.select("coin_id", "date", "rz_return", "rz_volume", *[f"{m}_flag" for m in methods])
    inside = events.join(near, "coin_id", "left").withColumn(
        "_in", F.coalesce(F.abs(F.date_diff("date", "event_date")) <= days, F.lit(False))
    )
    at = F.col("_in")
    return inside.groupBy("event", "coin_id", "event_date").agg(
        F.count_if(at).alias("rows"),
        *[F.coalesce(F.bool_or(at & F.col(f"{m}_flag")), F.lit(False)).alias(m) for m in methods],
        F.max(F.when(at, F.abs("rz_return"))).alias("max_abs_rz_return"),
        F.max(F.when(at, F.col("rz_volume"))).alias("max_rz_volume"),
    )


def market_wide(scored: DataFrame, dates: Sequence[str], *, methods: Sequence[str] = METHODS) -> DataFrame:
    """Share of entities that each method flags on the dates, against the median
    over all days."""
    daily = scored.groupBy("date").agg(*[F.avg(F.col(f"{m}_flag").cast("double")).alias(m) for m in methods])
    usual = daily.agg(*[F.median(m).alias(f"usual_{m}") for m in methods])
    return daily.where(F.col("date").isin([*dates])).crossJoin(F.broadcast(usual))  # one row


def planted(rows: DataFrame, score, *, strengths: Sequence[float] = STRENGTHS, seed: int = SEED) -> tuple[DataFrame, dict[float, DataFrame]]:
    """The sites, and rows scored with anomalies at them, by strength. score:
    features with anomalies -> scored rows."""
    sites = choose_sites(rows, seed=seed)
    return sites, {float(s): score(inject(rows, sites, s)) for s in strengths}


def sweep(measure, sites: DataFrame, scored: dict[float, DataFrame], *, methods: Sequence[str] = METHODS) -> DataFrame:
    """A measure (recall or precision_at_k) at every strength."""
    parts = [measure(rows, sites, methods=methods).withColumn("strength", F.lit(s)) for s, rows in scored.items()]
    return reduce(DataFrame.unionByName, parts)


def events_frame(spark: SparkSession, events: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(events), "event string, coin_id string, event_date string").withColumn(
        "event_date", F.to_date("event_date")
    )


