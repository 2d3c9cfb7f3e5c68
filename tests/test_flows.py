"""Runs over stored tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import load
from tidewatch.plans import flows

DAY = dt.date(2026, 1, 1)


@pytest.fixture()
def store(spark, tmp_path):
    s = flows.Store(spark, str(tmp_path))
    rows = [(c, DAY + dt.timedelta(days=i), 10 + math.sin(i * k), 1000.0, 100.0 + i % 7, "history") for k, c in enumerate("abcd") for i in range(60)]
    market = spark.createDataFrame(rows, "coin_id string, date date, price double, market_cap double, volume double, source string")
    noon = dt.datetime(2026, 1, 1, 12)
    people = "pqrs"
    moves = [("T", f"h{i}", 0, noon + dt.timedelta(hours=7 * i), people[i % 4], people[(i + 1 + i % 2) % 4], float(i % 13), "transfer()") for i in range(120)]
    transfers = spark.createDataFrame(moves, "token string, tx_hash string, tx_seq int, block_time timestamp_ntz, from_address string, to_address string, amount double, function_name string")
    labels = spark.createDataFrame([(p, False) for p in people], "address string, is_contract boolean")
    flows.full_load(s, market, transfers, labels)
    return s


def test_graph_order_and_cycles():
    assert flows.GRAPH.order(["anomaly_scores"]) == ["transforms", "features", "anomaly_scores"]
    g = flows.Graph()
    g.steps = {"a": (lambda s: None, ("b",)), "b": (lambda s: None, ("a",))}
    with pytest.raises(ValueError):
        g.order()


def test_full_run_flags_the_budget(store):
    flows.GRAPH.run(store)
    scores = store.read("anomaly_scores")
    flags = {r["entity_type"]: r["n"] for r in scores.where("zscore_flag").groupBy("entity_type").agg(F.count("*").alias("n")).collect()}
    sizes = {r["entity_type"]: r["n"] for r in scores.groupBy("entity_type").agg(F.count("*").alias("n")).collect()}
    assert flags == {"coin": max(1, round(sizes["coin"] * 0.01)), "token": max(1, round(sizes["token"] * 0.05))}


def test_snapshot_never_touches_the_history(store, spark):
    day = DAY + dt.timedelta(days=60)
    rows = spark.createDataFrame([("a", day, 1.0, None, 2.0)], "coin_id string, date date, price double, market_cap double, volume double")
    missing = {r["coin_id"] for r in flows.market_snapshot(store, rows, day).collect()}
    assert missing == {"b", "c", "d"} and store.read("market_daily_raw").count() == 241
    with pytest.raises(ValueError):
        flows.market_snapshot(store, rows, DAY)


def test_reconcile_overlays_and_is_idempotent(store, spark):
    rows = spark.createDataFrame([("a", DAY, 1.0, None, 200.0)], "coin_id string, date date, price double, market_cap double, volume double")
    assert flows.market_reconcile(store, rows).first()["median_change"] == 1.0
    mark = load.fingerprint(store.read("market_daily_raw")).first()
    flows.market_reconcile(store, rows)
    assert load.fingerprint(store.read("market_daily_raw")).first() == mark and mark["rows"] == 240


def test_transfer_update_replaces_the_last_day_once(store, spark):
    stored = store.read("token_transfers_raw")
    last = stored.agg(F.max("day").alias("d")).first()["d"]
    again = stored.where(F.col("day") == last).drop("day")
    new = again.limit(1).withColumn("tx_hash", F.lit("new")).withColumn("block_time", F.col("block_time") + F.expr("INTERVAL 1 DAY"))
    fetched = again.unionByName(again).unionByName(new).cache()
    fetched.count()
    marks = []
    for _ in range(2):
        flows.transfer_update(store, fetched)
        marks.append(load.fingerprint(store.read("token_transfers_raw"), ["tx_hash", "amount"]).first())
    assert marks[0] == marks[1] and marks[0]["rows"] == 121
