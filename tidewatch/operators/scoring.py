"""Model rows, detector scores, flags and votes; the table of anomaly scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import detectors
from tidewatch.operators.robust import FEATURES as ROBUST
from tidewatch.operators.robust import robust_market_features
from tidewatch.operators.storage import settle

MARKET_BUDGET, TOKEN_BUDGET = 0.01, 0.05
METHODS = ("zscore", "iforest", "lof")
TOKEN_FEATURES = ("transfers_z", "addresses_z", "rt_share_z", "tpa_z", "concentration_z", "large_transfers_z")
TOKEN_NEIGHBORS = 10
DIGITS = 6  # of features as they are scored, so that engines agree on scores and ties


def model_rows(rows: DataFrame) -> DataFrame:
    """Rows whose return, volume and residual scores are known; an unknown
    turnover counts as ordinary."""
    return rows.dropna(subset=["rz_return", "rz_volume", "rz_residual"]).fillna(0.0, ["rz_turnover"])


def fixed(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    return rows.withColumns({c: F.round(c, DIGITS) for c in features})


def score(
    rows: DataFrame, key: Sequence[str], features: Sequence[str], *, budget: float, n_neighbors: int = detectors.NEIGHBORS,
    methods: Sequence[str] = METHODS, trees: int = detectors.TREES,
) -> DataFrame:
    """rows with <method>_score and <method>_flag of each method and votes."""
    if "zscore" in methods:
        rows = rows.withColumn("zscore_score", detectors.zscore_score(features))
    if "iforest" in methods:
        rows = detectors.isolation_forest_score(rows, key, features, trees=trees)
    if "lof" in methods:
        rows = detectors.lof_score(rows, features, n_neighbors=n_neighbors)
    rows = settle(rows, "scored")
    for m in methods:
        rows = detectors.flag_top(rows, f"{m}_score", key, rate=budget, out=f"{m}_flag")
    votes = sum((F.col(f"{m}_flag").cast("int") for m in methods), F.lit(0))
    return rows.withColumn("votes", votes)


def score_market(features: DataFrame, *, budget: float = MARKET_BUDGET, methods: Sequence[str] = METHODS, trees: int = detectors.TREES) -> DataFrame:
    rows = settle(fixed(model_rows(robust_market_features(features)), ROBUST), "model-rows")
    return score(rows, ["coin_id", "date"], ROBUST, budget=budget, methods=methods, trees=trees)


def token_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("transfers_z").isNotNull()).fillna(0.0, list(TOKEN_FEATURES))


def score_tokens(features: DataFrame, *, budget: float = TOKEN_BUDGET, methods: Sequence[str] = METHODS, trees: int = detectors.TREES) -> DataFrame:
    rows = settle(fixed(token_rows(features), TOKEN_FEATURES), "token-rows")
    return score(rows, ["token", "day"], TOKEN_FEATURES, budget=budget, n_neighbors=TOKEN_NEIGHBORS, methods=methods, trees=trees)


def anomaly_scores(market: DataFrame, tokens: DataFrame) -> DataFrame:
    """Both domains in one schema."""
    columns = [f"{m}_{what}" for what in ("score", "flag") for m in METHODS] + ["votes"]
    coins = market.select(F.lit("coin").alias("entity_type"), F.col("coin_id").alias("entity"), "date", *columns)
    days = tokens.select(F.lit("token").alias("entity_type"), F.col("token").alias("entity"), F.col("day").alias("date"), *columns)
    return coins.unionByName(days)
