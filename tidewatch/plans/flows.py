"""The engine's runs as a small graph of steps over stored tables: full load,
daily snapshot, transfer update, weekly reconcile, features, scores, checks.

A step reads and writes tables by name under one root. Steps that other steps
need run first, each once; contracts that fail stop the run before anything
downstream is written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import contracts, load, market, quality, scoring, transfers
from tidewatch.operators.storage import settle
from tidewatch.schemas import TABLES


@dataclass
class Store:
    """Tables under a root that every executor can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def has(self, name: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def write(self, rows: DataFrame, name: str, *, partition: str | None = None) -> None:
        order = [c for c in TABLES[name].key if c != partition] if name in TABLES else ()
        load.overwrite(rows, self.path(name), partition=partition, order=order)


Step = Callable[[Store], None]


@dataclass
class Graph:
    steps: dict[str, tuple[Step, tuple[str, ...]]] = field(default_factory=dict)

    def step(self, *needs: str) -> Callable[[Step], Step]:
        def add(f: Step) -> Step:
            self.steps[f.__name__] = (f, needs)
            return f

        return add

    def order(self, wanted: Iterable[str] | None = None) -> list[str]:
        out: list[str] = []

        def visit(name: str, above: tuple[str, ...] = ()) -> None:
            if name in above:
                raise ValueError(f"steps need each other: {' -> '.join([*above, name])}")
            if name not in out:
                for n in self.steps[name][1]:
                    visit(n, (*above, name))
                out.append(name)

        for name in wanted or self.steps:
            visit(name)
        return out

    def run(self, store: Store, wanted: Iterable[str] | None = None) -> list[str]:
        done = self.order(wanted)
        for name in done:
            self.steps[name][0](store)
        return done


GRAPH = Graph()


@GRAPH.step()
def transforms(store: Store) -> None:
    """Verdicts, the clean view and the token rollup, then the contracts."""
    raw, moved = store.read("market_daily_raw"), store.read("token_transfers_raw")
    flagged = quality.flag_daily(raw)
    store.write(flagged, "market_daily_flagged")
    flagged = store.read("market_daily_flagged")
    store.write(quality.verdicts(flagged), "coin_quality")
    verdict = store.read("coin_quality")
    store.write(quality.clean(flagged, verdict), "market_daily_clean")
    store.write(transfers.token_daily(moved), "token_daily")
    rules = contracts.singular(raw, flagged, verdict, store.read("market_daily_clean"), moved, store.read("token_daily"))
    contracts.require(contracts.run(rules))


@GRAPH.step("transforms")
def features(store: Store) -> None:
    store.write(market.market_features(store.read("market_daily_clean")), "market_features")
    activity = transfers.daily_activity(store.read("token_transfers_raw"), store.read("address_labels"))
    store.write(transfers.activity_features(activity), "onchain_features")
    checks = contracts.verify_features(
        store.read("market_daily_clean"), store.read("market_features"), store.read("token_daily"), store.read("onchain_features")
    )
    contracts.require(checks.where(F.col("check") != "features_present"))


@GRAPH.step("features")
def anomaly_scores(store: Store) -> None:
    coins = scoring.score_market(store.read("market_features"))
    tokens = scoring.score_tokens(store.read("onchain_features"))
    store.write(scoring.anomaly_scores(coins, tokens), "anomaly_scores")


def full_load(store: Store, market_rows: DataFrame, transfer_rows: DataFrame, labels: DataFrame) -> None:
    """Every stored table from its sources; the keys must be unique."""
    store.write(market_rows, "market_daily_raw", partition="date")
    dated = transfer_rows.withColumn("day", F.to_date("block_time"))
    store.write(dated, "token_transfers_raw", partition="day")
    store.write(labels, "address_labels")
    contracts.require(
        contracts.key_check(store.read("market_daily_raw"), ["coin_id", "date"], "market_keys").unionByName(
            contracts.key_check(store.read("token_transfers_raw"), ["token", "tx_hash", "tx_seq"], "transfer_keys")
        )
    )


def market_snapshot(store: Store, rows: DataFrame, day: dt.date) -> DataFrame:
    """Replaces one day by a snapshot's rows; the history is never overwritten.
    Gives the tracked entities that the snapshot lacks."""
    raw = store.read("market_daily_raw")
    end = load.history_end(raw).first()["history_end"]
    if end is not None and day <= end:
        raise ValueError(f"{day} belongs to the history, which ends {end}")
    new = rows.where(F.col("date") == F.lit(day)).withColumn("source", F.lit("snapshot")).select(*raw.columns)
    load.write_days(store.spark, new, store.path("market_daily_raw"), [day.isoformat()], day="date")
    return raw.select("coin_id").distinct().join(new.select("coin_id"), "coin_id", "left_anti")


def market_reconcile(store: Store, rows: DataFrame) -> DataFrame:
    """Overlays corrected rows on their days; gives how far volumes moved."""
    raw = store.read("market_daily_raw")
    new = rows.withColumn("source", F.lit("reconciled")).select(*raw.columns)
    days = [r["date"] for r in new.select("date").distinct().collect()]  # the days of one run
    before = raw.where(F.col("date").isin(days))
    change = settle(load.reconcile_change(before, new), "change")
    merged = settle(load.overlay(before, new), "reconciled")  # read before its days are rewritten
    load.write_days(store.spark, merged, store.path("market_daily_raw"), [d.isoformat() for d in days], day="date")
    return change


def transfer_update(store: Store, fetched: DataFrame) -> list[str]:
    """Replaces the days that a refetch touches: from the earliest of the
    tokens' last stored days on. Of rows of one key the last in fetch order
    (columns path and line, if there) stays, else the greatest, so that running
    it again changes nothing."""
    stored = store.read("token_transfers_raw")
    days = [str(r["day"]) for r in load.touched_days(stored, fetched).collect()]  # the days of one run
    start = min(days)
    inside = fetched.withColumn("day", F.to_date("block_time")).where(F.col("day") >= start)
    whole = [F.struct(*sorted(c for c in stored.columns if c not in load.TRANSFER_KEY))]
    placed = [load.file_order(F.col("path")), F.col("path"), F.col("line")] if {"path", "line"} <= set(fetched.columns) else []
    once = load.latest(inside, load.TRANSFER_KEY, [*placed, *whole]).select(*stored.columns)
    load.write_days(store.spark, once, store.path("token_transfers_raw"), days)
    return days
