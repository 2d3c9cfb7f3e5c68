"""Loading: last-wins dedupe, upserts by source, partition replacement,
order-free fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.selection import nth_row
from tidewatch.operators.storage import settle

TRANSFER_KEY = ("token", "tx_hash", "tx_seq")
RANK = {"history": 0, "snapshot": 1, "reconciled": 2}


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key in the given order. max_by keeps one row a key
    while it aggregates, before any shuffle."""
    rest = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*key).agg(best.alias("_best")).select(*key, "_best.*").select(*rows.columns)


def file_order(path: Column) -> Column:
    """Numeric end block in an update file's name; base files come first."""
    digits = F.regexp_extract(path, r"(\d+)[^0-9/]*$", 1)
    return F.when(F.contains(path, F.lit("incremental")), digits.try_cast("long")).otherwise(F.lit(-1).cast("long"))


def transfers_in_order(base: DataFrame, updates: DataFrame, *, path: str = "path", line: str = "line") -> DataFrame:
    """Base rows and updates in fetch order, one of each key: the last."""
    both = base.unionByName(updates)
    return latest(both, TRANSFER_KEY, [file_order(F.col(path)), F.col(path), F.col(line)])


def merge_later_days(snapshots: DataFrame, reconciled: DataFrame) -> DataFrame:
    """One row per entity and day: a reconciled row beats a snapshot, a later
    run (column run) an earlier one."""
    both = snapshots.withColumn("source", F.lit("snapshot")).unionByName(reconciled.withColumn("source", F.lit("reconciled")))
    return latest(both, ["coin_id", "date"], [source_rank(F.col("source")), F.col("run")])


def source_rank(source: Column) -> Column:
    out = F.lit(-1)
    for name, rank in RANK.items():
        out = F.when(source == name, rank).otherwise(out)
    return out


def later_market_rows(snapshots: DataFrame, reconciled: DataFrame, history_end: Column) -> DataFrame:
    """Rows after the history: reconciled ones count between its end and their run."""
    inside = (F.col("date") > history_end) & (F.col("date") < F.to_date("run"))
    return merge_later_days(snapshots.where(F.col("date") > history_end), reconciled.where(inside))


def replace_days(old: DataFrame, new: DataFrame, days: Sequence, *, day: str = "day") -> DataFrame:
    """old with the listed days taken from new; a listed day without new rows
    becomes empty, other days stay, new rows of other days don't enter."""
    listed = F.col(day).isin([*days]) if len(days) else F.lit(False)
    return old.where(~F.coalesce(listed, F.lit(False))).unionByName(new.where(listed))


def write_days(spark: SparkSession, new: DataFrame, path: str, days: Sequence[str], *, day: str = "day") -> None:
    """replace_days on a table partitioned by day: only the listed partitions
    are rewritten, and those that stay empty are removed."""
    kept = new.where(F.col(day).isin([*days]))
    full = {str(r[day]) for r in kept.select(day).distinct().collect()}  # at most the listed days
    kept.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    jvm = spark._jvm
    for d in days:
        if str(d) not in full:
            gone = jvm.org.apache.hadoop.fs.Path(f"{path}/{day}={d}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def overlay(before: DataFrame, newer: DataFrame, key: Sequence[str] = ("coin_id", "date")) -> DataFrame:
    """before with newer's rows in place of those of the same key."""
    return before.join(newer.select(*key), list(key), "left_anti").unionByName(newer)


def reconcile_change(before: DataFrame, newer: DataFrame, key: Sequence[str] = ("coin_id", "date")) -> DataFrame:
    """One row: rows compared and the upper median of relative volume change
    where the volume before was not zero."""
    then = before.select(*key, F.col("volume").alias("_before"))
    both = newer.join(then, list(key)).where(F.col("_before") != 0)
    change = F.abs(F.col("volume") / F.col("_before") - 1)
    changes = settle(both.select(change.alias("change"), *key), "changes")
    n = changes.count()
    upper = nth_row(changes, [F.asc("change"), *map(F.asc, key)], n // 2 + 1)
    told = changes.sparkSession.range(1).select(F.lit(n).cast("long").alias("rows"))
    return told.withColumn("median_change", F.lit(upper["change"] if upper else None).cast("double"))


def touched_days(stored: DataFrame, fetched: DataFrame, *, token: str = "token", time: str = "block_time") -> DataFrame:
    """The days an update replaces: the earliest of the tokens' last stored
    days, and the days present in what was fetched from there on."""
    last = stored.groupBy(token).agg(F.max(F.to_date(time)).alias("last"))
    start = last.agg(F.min("last").alias("day"))
    present = fetched.select(F.to_date(time).alias("day")).distinct()
    return start.unionByName(present).where("day IS NOT NULL").distinct()


def fingerprint(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, hash): the same for the same multiset of rows in any order."""
    columns = sorted(columns or rows.columns)
    h = F.xxhash64(*columns)
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0).cast("long")).alias("hash"))


def history_end(market: DataFrame) -> DataFrame:
    return market.where(F.col("source") == "history").agg(F.max("date").alias("history_end"))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def overwrite(rows: DataFrame, path: str, *, partition: str | None = None, order: Sequence[str] = ()) -> None:
    """A full reload: a table is replaced as a whole."""
    if order:
        rows = rows.sortWithinPartitions(*order)
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
