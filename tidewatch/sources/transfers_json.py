"""Token transfers from JSON lines, in Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed names of the records' fields.
FIELDS = (
    "blockNumber", "timeStamp", "hash", "txSeq", "transactionIndex", "from", "to", "value", "tokenDecimal", "gasUsed", "gasPrice",
    "methodId", "functionName", "contractAddress",
)
#: Fixed list of the tracked tokens and their entities.
TRACKED_TOKENS = {"LINK": "chainlink", "PEPE": "pepe", "LOOKS": "looksrare"}


def number_within_tx(records: DataFrame, *, position: str = "pos") -> DataFrame:
    """records with txSeq: a counter from 0 per transaction in arrival order."""
    order = W.partitionBy("hash").orderBy(position)
    return records.withColumn("txSeq", (F.row_number().over(order) - 1).cast("int"))


def slim(records: DataFrame) -> DataFrame:
    """The stored fields alone, null where a record lacks one."""
    return records.select(*[F.col(f"`{f}`") if f in records.columns else F.lit(None).cast("string").alias(f) for f in FIELDS])


def parse_transfers(records: DataFrame, *, token: str = "token", keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows. value_raw keeps every digit; amount is value / 10^decimals.
    keep: further columns that come along."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    number = lambda c, kind: F.coalesce(text(c).cast(kind), F.lit(0).cast(kind))
    decimals = number("tokenDecimal", "int")
    return records.select(
        F.col(token).alias("token"),
        number("blockNumber", "long").alias("block_number"),
        F.timestamp_seconds(text("timeStamp").cast("long")).alias("block_time"),
        text("hash").alias("tx_hash"),
        number("txSeq", "int").alias("tx_seq"),
        number("transactionIndex", "long").alias("tx_index"),
        F.lower(text("from")).alias("from_address"),
        F.lower(text("to")).alias("to_address"),
        F.coalesce(text("value"), F.lit("0")).alias("value_raw"),
        (F.coalesce(text("value"), F.lit("0")).cast("double") / F.pow(F.lit(10.0), decimals)).alias("amount"),
        decimals.alias("decimals"),
        number("gasUsed", "decimal(20,0)").alias("gas_used"),
        number("gasPrice", "decimal(20,0)").alias("gas_price"),
        F.coalesce(text("methodId"), F.lit("")).alias("method_id"),
        F.coalesce(text("functionName"), F.lit("")).alias("function_name"),
        *keep,
    )


def read_transfers(spark: SparkSession, path: str, token: str, *, placed: bool = False) -> DataFrame:
    """JSON lines, gzip or not; every field a string until it is typed. placed:
    with the file (path) and a number that grows with its lines (line), which
    tell fetch order."""
    schema = ", ".join(f"`{f}` string" for f in FIELDS)
    lines = spark.read.schema(schema).json(path)
    if placed:
        lines = lines.select("*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"))
    return parse_transfers(lines.withColumn("token", F.lit(token)), keep=("path", "line") if placed else ())


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """The label cache's lines as rows of address_labels."""
    kind = "address string, is_contract boolean, record struct<contractCreator: string, contractFactory: string, blockNumber: string>"
    lines = spark.read.schema(kind).json(path)
    return lines.select(
        "address", "is_contract",
        F.coalesce("record.contractCreator", F.lit("")).alias("creator"), F.coalesce("record.contractFactory", F.lit("")).alias("factory"),
        F.coalesce(F.col("record.blockNumber").cast("long"), F.lit(0).cast("long")).alias("created_block"),
    )


def label_addresses(addresses: DataFrame, creations: DataFrame) -> DataFrame:
    """Each wanted address with the creation record that shows it is a contract."""
    made = creations.select(
        F.lower("contractAddress").alias("_key"),
        F.col("contractCreator").alias("creator"),
        F.col("contractFactory").alias("factory"),
        F.col("blockNumber").cast("long").alias("created_block"),
        F.lit(True).alias("_made"),
    )
    joined = addresses.withColumn("_key", F.lower("address")).join(made, "_key", "left")
    return joined.select(
        "address", F.coalesce("_made", F.lit(False)).alias("is_contract"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("creator", "factory")], F.coalesce("created_block", F.lit(0).cast("long")).alias("created_block"),
    )


def unlabelled(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    return candidates.join(labels.select("address"), "address", "left_anti")


def tracked_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TRACKED_TOKENS.items()), "token string, coin_id string")


def coverage(transfers: DataFrame, end: str, *, max_gap_hours: int = 6) -> DataFrame:
    """Per token the last row and whether it lies too far before the end."""
    last = transfers.groupBy("token").agg(F.max("block_time").alias("last"))
    gap = F.unix_timestamp(F.lit(end).cast("timestamp")) - F.unix_timestamp("last")
    return last.withColumn("late", gap > max_gap_hours * 3600)
