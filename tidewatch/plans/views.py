"""The engine's inputs as views over the driver's tables: daily series from
order lines, a transfer graph from events, labels for its addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ADDRESSES = 40
FUNCTIONS = ("swapExactTokensForTokens(uint256)", "transfer(address,uint256)", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact(c: Column) -> Column:
    """A sum that doesn't depend on the order of rows."""
    return F.sum(c.cast("decimal(18,4)")).cast("double")


def _series(rows: DataFrame, entity: str, date: str) -> DataFrame:
    price, volume = F.col("l_extendedprice"), _exact(F.col("l_extendedprice"))
    return rows.groupBy(F.col(entity).alias("coin_id"), F.to_date(date).alias("date")).agg(
        (volume / _exact(F.col("l_quantity"))).alias("price"),
        (20 * _exact(price * (1 - F.col("l_discount")))).alias("market_cap"),
        volume.alias("volume"),
    )


def market_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_shipdate")


def market_daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return _series(lines.join(orders, "l_orderkey").join(parts, "l_partkey"), "p_brand", "o_orderdate")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    address = F.concat(F.lit("a"), (F.col("user_id") % ADDRESSES).cast("string"))
    after = F.lead(address).over(W.partitionBy("event_type").orderBy("ts", "event_id"))
    name = F.array(*map(F.lit, FUNCTIONS))[(F.col("user_id") % len(FUNCTIONS)).cast("int")]
    return events.select(
        F.col("event_type").alias("token"),
        F.col("event_id").cast("string").alias("tx_hash"),
        F.lit(0).alias("tx_seq"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("block_time"),
        address.alias("from_address"),
        after.alias("to_address"),
        F.col("value").alias("amount"),
        name.alias("function_name"),
    ).where("to_address IS NOT NULL")


def address_labels(spark: SparkSession) -> DataFrame:
    """Every tenth address a contract, every tenth unlabelled, the rest wallets."""
    n = spark.range(ADDRESSES).where("id % 10 <> 9")
    return n.select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("address"), (F.col("id") % 10 == 0).alias("is_contract"))
