"""Daily market data from JSON documents, in Spark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MS = 86_400_000
CHART = "prices array<array<double>>, market_caps array<array<double>>, total_volumes array<array<double>>"
SNAPSHOT = "array<struct<id:string, current_price:double, market_cap:double, total_volume:double>>"
SERIES = {"price": "prices", "market_cap": "market_caps", "volume": "total_volumes"}
WINDOW_HOURS = 3


def parse_market_chart(documents: DataFrame, *, coin: str = "coin_id", body: str = "body") -> DataFrame:
    """coin_id, date, price, market_cap, volume. Three series of [ms, value]
    meet on their stamps. Only exact UTC midnights count; a midnight closes the
    day before. Of repeated stamps in a series the last wins; a missing or null
    series gives nulls."""
    parsed = documents.select(F.col(coin).alias("coin_id"), F.from_json(body, CHART).alias("j"))
    points = None
    for field, key in SERIES.items():
        own = parsed.select(
            "coin_id", F.lit(field).alias("field"), F.posexplode(F.coalesce(F.col(f"j.{key}"), F.array().cast("array<array<double>>")))
        ).select("coin_id", "field", "pos", F.col("col")[0].cast("long").alias("ms"), F.col("col")[1].alias("v"))
        points = own if points is None else points.unionByName(own)
    midnight = points.where(F.col("ms") % DAY_MS == 0)
    last = lambda f: F.max_by(
        F.when(F.col("field") == f, F.struct("v")), F.when(F.col("field") == f, F.col("pos"))
    )["v"].alias(f)
    day = F.date_sub(F.date_from_unix_date((F.col("ms") / DAY_MS).cast("int")), 1).alias("date")
    return midnight.groupBy("coin_id", "ms").agg(*[last(f) for f in SERIES]).select("coin_id", day, *SERIES)


def snapshot_day(fetched_at: dt.datetime, *, window_hours: int = WINDOW_HOURS) -> dt.date:
    """The day that a snapshot closes: the one before, if taken soon after
    midnight UTC. Later ones are mid-day prices and are refused."""
    if fetched_at.tzinfo is None:
        raise ValueError("the time of a snapshot needs a time zone")
    utc = fetched_at.astimezone(dt.UTC)
    if utc.hour >= window_hours:
        raise ValueError(f"a snapshot of {utc:%H:%M} UTC is no close of the day before")
    return utc.date() - dt.timedelta(days=1)


def snapshot_day_column(at: Column, *, window_hours: int = WINDOW_HOURS) -> Column:
    """The same for a column of UTC timestamps; a late one raises in the query."""
    late = F.raise_error(F.concat(F.lit("snapshot too late: "), at.cast("string"))).cast("date")
    return F.when(F.hour(at) < window_hours, F.date_sub(F.to_date(at), 1)).when(at.isNotNull(), late)


def parse_snapshot(documents: DataFrame, *, body: str = "body", day: str = "day", tracked: DataFrame | None = None) -> DataFrame:
    """coin_id, date, price, market_cap, volume of one day's snapshot. Entities
    that are not tracked, or lack a price or volume, are left out."""
    each = documents.select(F.col(day).alias("date"), F.explode(F.from_json(body, SNAPSHOT)).alias("c"))
    rows = each.select(
        F.col("c.id").alias("coin_id"),
        "date",
        F.col("c.current_price").alias("price"),
        F.col("c.market_cap").alias("market_cap"),
        F.col("c.total_volume").alias("volume"),
    ).where("price IS NOT NULL AND volume IS NOT NULL")
    return rows if tracked is None else rows.join(tracked.select("coin_id"), "coin_id", "left_semi")


def read_charts(spark, path: str) -> DataFrame:
    """One document per file; the file's name is the entity."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    return parse_market_chart(files.select(name.alias("coin_id"), F.col("value").alias("body")))


def read_coins(spark, path: str) -> DataFrame:
    """The entity list, stamped with its file's time."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_modification_time").alias("snapshot_at"))
    kind = "array<struct<id:string, symbol:string, name:string, market_cap_rank:bigint>>"
    each = files.select("snapshot_at", F.explode(F.from_json("value", kind)).alias("c"))
    return each.select(F.col("c.id").alias("coin_id"), "c.symbol", "c.name", "c.market_cap_rank", "snapshot_at")
