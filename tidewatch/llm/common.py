"""Shared pieces of the training-data operators: shared-storage tables, size
estimates, stable bucketing and distributed connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases ASCII letters only, as the contracts ask for.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Folders that are deleted when their application ends.
_leaving: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the
    session. Only where that is unset and all runs in one process (tests, a
    laptop) a temporary folder is made and remembered in the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def settle(df: DataFrame, name: str, *, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df once as zstd Parquet in the shared folder and reads it back:
    cuts lineage, survives lost executors, and is never computed twice. What
    release() has not deleted by then goes when the application ends."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tidewatch-{spark.sparkContext.applicationId}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if folder not in _leaving:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _leaving.add(folder)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.tidewatch_path = path
    return back


def release(*frames: DataFrame) -> None:
    """Deletes tables written by settle() that no later plan reads."""
    for df in frames:
        path = getattr(df, "tidewatch_path", None)
        if path:
            jvm, spark = df.sparkSession._jvm, df.sparkSession
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Jobs inside send Python workers so many rows at a time: batches that hold
    whole texts are kept small on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def connected_components(
    edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 60
) -> DataFrame:
    """(node, component) for every node that has an edge; component is the
    smallest node reachable. Nulls on either end are no edge.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    round groups neighbours by node, hangs the larger (then the smaller) ones
    on the smallest, and stops when a round changes nothing. Every step is a
    min-aggregation with map-side combine plus an equi-join that AQE may split,
    so a node with a third of all edges is no single task. Rounds grow with the
    logarithm of the component size; each is written to the shared folder.
    """
    e = (
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = settle(e, "cc-edges")
    stamp = None
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low2.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        done = settle(small, "cc-edges")
        release(e)
        e = done
        mark = e.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40))).alias("s"),
        ).first()
        if mark == stamp:
            break
        stamp = mark
    else:
        raise RuntimeError("connected components did not settle")
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
