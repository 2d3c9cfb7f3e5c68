"""Explicit schemas of the stored tables, with their keys and partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    ddl: str
    key: tuple[str, ...]
    partition: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


SCORES = "zscore_score double, iforest_score double, lof_score double, zscore_flag boolean, iforest_flag boolean, lof_flag boolean, votes int"

TABLES = {
    "coins": Table("coin_id string, symbol string, name string, market_cap_rank long, snapshot_at timestamp", ("coin_id",)),
    "market_daily_raw": Table(
        "coin_id string, date date, price double, market_cap double, volume double, source string", ("coin_id", "date"), "date"
    ),
    "token_transfers_raw": Table(
        "token string, block_number long, block_time timestamp, tx_hash string, tx_seq int, tx_index long, from_address string,"
        " to_address string, value_raw string, amount double, decimals int, gas_used decimal(20,0), gas_price decimal(20,0),"
        " method_id string, function_name string",
        ("token", "tx_hash", "tx_seq"),
        "day",
    ),
    "address_labels": Table("address string, is_contract boolean, creator string, factory string, created_block long", ("address",)),
    "market_features": Table(
        "coin_id string, date date, price double, market_cap double, volume double, log_return double, extreme_move boolean,"
        " market_return double, n_history long, return_z double, volume_z double, turnover_z double, market_corr double,"
        " market_beta double, residual_return double, residual_z double, volume_price_gap double",
        ("coin_id", "date"),
    ),
    "anomaly_scores": Table(f"entity_type string, entity string, date date, {SCORES}", ("entity_type", "entity", "date")),
}
SOURCES = ("history", "snapshot", "reconciled")
STATUSES = ("ok", "feed_glitch", "stale_feed")
ENTITY_TYPES = ("coin", "token")
