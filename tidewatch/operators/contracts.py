"""Data contracts: builders give the rows that break a rule, checks give
(check, passed, detail)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.stats import limb_sums
from tidewatch.operators.detectors import budget_size

Pair = tuple[DataFrame, DataFrame]


class FailedContracts(RuntimeError):
    """Some checks failed; a run must not go on."""


#: Rows and the condition that breaks the rule: rules of one table are counted in one pass.
RowRule = tuple[DataFrame, Column]


def unique(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys, none of whose columns is null, that occur more than once."""
    known = rows.dropna(subset=list(columns))
    return known.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return rows.where(_other_than(column, values))


def relationship(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = rows.where(F.col(column).isNotNull())
    return known.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def _other_than(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin([*values])


def singular(market: DataFrame, flagged: DataFrame, quality: DataFrame, clean: DataFrame, transfers: DataFrame, daily: DataFrame) -> dict[str, DataFrame | RowRule]:
    """The nine rules of the domain."""
    bad = quality.where(F.col("status") != "ok")
    per_coin = clean.groupBy("coin_id").agg(F.count_if("extreme_move").alias("n"))
    per_token = daily.groupBy("token").agg(F.count_if(F.col("is_partial_day") == 1).alias("n"))
    return {
        "first_row_never_flagged": (flagged, F.col("prev_price").isNull() & F.col("extreme_move")),
        "clean_excludes_bad_coins": clean.join(bad.select("coin_id"), "coin_id", "left_semi"),
        "clean_has_no_volume_glitches": (clean, F.col("volume_glitch")),
        "clean_has_no_repeated_extreme_moves": per_coin.where(F.col("n") > 1),
        "market_keys_unique": unique(market, ["coin_id", "date"]),
        "transfer_keys_unique": unique(transfers, ["token", "tx_hash", "tx_seq"]),
        "token_daily_keys_unique": unique(daily, ["token", "day"]),
        "token_daily_matches_raw": rollup_mismatch(transfers, daily),
        "only_edge_days_partial": per_token.where(F.col("n") > 2),
    }


def rollup_mismatch(transfers: DataFrame, daily: DataFrame) -> DataFrame:
    """Tokens whose rollup does not add up to the raw rows, or that one side lacks."""
    raw = transfers.groupBy("token").agg(F.count("*").alias("raw_transfers"))
    rolled = daily.groupBy("token").agg(F.sum("transfers").alias("rollup_transfers"))
    return raw.join(rolled, "token", "full_outer").where(~F.col("raw_transfers").eqNullSafe(F.col("rollup_transfers")))


def generic(market: DataFrame, coins: DataFrame, quality: DataFrame, scores: DataFrame, labels: DataFrame) -> dict[str, DataFrame | RowRule]:
    from tidewatch.schemas import ENTITY_TYPES, SOURCES, STATUSES

    out = {
        "coins_id_unique": unique(coins, ["coin_id"]),
        "market_coin_known": relationship(market, "coin_id", coins, "coin_id"),
        "market_source_known": (market, _other_than("source", SOURCES)),
        "quality_coin_unique": unique(quality, ["coin_id"]),
        "quality_coin_known": relationship(quality, "coin_id", coins, "coin_id"),
        "quality_status_known": (quality, _other_than("status", STATUSES)),
        "scores_entity_type_known": (scores, _other_than("entity_type", ENTITY_TYPES)),
        "labels_address_unique": unique(labels, ["address"]),
    }
    for name, rows, columns in (
        ("coins", coins, ("coin_id",)),
        ("market", market, ("coin_id", "date", "price", "source")),
        ("labels", labels, ("address", "is_contract")),
        ("scores", scores, ("entity", "date")),
    ):
        out |= {f"{name}_{c}_not_null": (rows, F.col(c).isNull()) for c in columns}
    return out


def run(rules: dict[str, DataFrame | RowRule]) -> DataFrame:
    """(check, passed, violations) of every rule, one row each. A rule is the
    rows that break it, or a RowRule."""
    counts: list[DataFrame] = []
    by_table: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for name, rule in rules.items():
        if isinstance(rule, DataFrame):
            counts.append(rule.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations"))
        else:
            by_table.setdefault(id(rule[0]), (rule[0], {}))[1][name] = rule[1]
    for rows, broken in by_table.values():
        one = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in broken.items()])
        counts.append(one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in broken]))))
    whole = reduce(DataFrame.unionByName, counts)
    return whole.select("check", (F.col("violations") == 0).alias("passed"), "violations")


def require(checks: DataFrame) -> DataFrame:
    failed = [r["check"] for r in checks.where(~F.col("passed")).collect()]  # a row per rule
    if failed:
        raise FailedContracts(", ".join(failed))
    return checks


def key_check(rows: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Rows against distinct keys, nulls counted as values."""
    counts = rows.agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*key)).alias("keys"))
    return counts.select(
        F.lit(name).alias("check"), (F.col("rows") == F.col("keys")).alias("passed"),
        F.format_string("%d rows, %d keys", "rows", "keys").alias("detail"),
    )


def budget_check(scored: DataFrame, methods: Sequence[str], rate: float) -> DataFrame:
    """Each method flags exactly its budget."""
    flags = scored.agg(F.count("*").alias("n"), *[F.count_if(f"{m}_flag").alias(m) for m in methods])
    met: Column = F.lit(True)
    for m in methods:
        met = met & (F.col(m) == budget_size(F.col("n"), rate))
    detail = F.concat_ws(" ", *[F.concat(F.lit(f"{m}="), F.col(m).cast("string")) for m in methods])
    return flags.select(F.lit("alert_budget").alias("check"), met.alias("passed"), detail.alias("detail"))


def verify_features(clean: DataFrame, features: DataFrame, daily: DataFrame, token_features: DataFrame) -> DataFrame:
    """Five checks after a feature build: rows kept, nothing infinite, features
    present, edge days gone, counts equal to the rollup's."""
    numeric = [f.name for f in features.schema.fields if f.dataType.typeName() == "double"]
    infinite = F.lit(False)
    for c in numeric:
        infinite = infinite | F.coalesce((F.abs(c) == float("inf")) | F.isnan(c), F.lit(False))
    kept = features.agg(F.count("*").alias("have"), F.count_if(infinite).alias("bad"), F.count("return_z").alias("scored"))
    wanted = clean.agg(F.count("*").alias("want"))
    one = kept.crossJoin(F.broadcast(wanted))  # one row each
    days = daily.groupBy("token").agg((F.greatest(F.count("*") - 2, F.lit(0))).alias("want"))
    have = token_features.groupBy("token").agg(F.count("*").alias("have"))
    edges = days.join(have, "token", "left").where(F.coalesce("have", F.lit(0)) != F.col("want"))
    other = token_features.select("token", "day", F.col("transfers").alias("t")).join(daily, ["token", "day"]).where("t <> transfers")
    checks = one.select(
        F.inline(
            F.array(
                _check("rows_preserved", F.col("have") == F.col("want"), F.col("have")),
                _check("no_infinities", F.col("bad") == 0, F.col("bad")),
                _check("features_present", F.col("scored") > 0, F.col("scored")),
            )
        )
    )
    for name, rows in (("edge_days_dropped", edges), ("counts_match_rollup", other)):
        checks = checks.unionByName(
            rows.agg(F.count("*").alias("n")).select(
                F.lit(name).alias("check"), (F.col("n") == 0).alias("passed"), F.col("n").cast("string").alias("detail")
            )
        )
    return checks


def _check(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"), detail.cast("string").alias("detail"))


def load_check(parsed: DataFrame, stored: DataFrame, key: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """What a load should hold, recounted from its sources: rows and content."""
    from tidewatch.operators.load import fingerprint

    a = fingerprint(parsed, columns).select(F.col("rows").alias("r1"), F.col("hash").alias("h1"))
    b = fingerprint(stored, columns).select(F.col("rows").alias("r2"), F.col("hash").alias("h2"))
    both = a.crossJoin(F.broadcast(b))  # one row each
    return both.select(
        F.lit(name).alias("check"), ((F.col("r1") == F.col("r2")) & (F.col("h1") == F.col("h2"))).alias("passed"),
        F.format_string("%d parsed, %d stored", "r1", "r2").alias("detail"),
    )


def verify_load(coins: Pair, market: Pair, transfers: Pair, daily: DataFrame) -> DataFrame:
    """(check, passed, detail): what files hold against what was stored, each a
    pair (parsed, stored), recounted apart from the loader: rows, distinct keys,
    exact sums of raw values by token, and the rollup's sum."""
    counts = []
    for name, (parsed, stored) in (("coins", coins), ("market rows", market)):
        a, b = parsed.agg(F.count("*").cast("string").alias("want")), stored.agg(F.count("*").cast("string").alias("have"))
        counts.append(a.crossJoin(F.broadcast(b)).select(F.lit(name).alias("check"), "want", "have"))  # one row each
    keys = market[1].agg(F.count_distinct("coin_id", "date").cast("string").alias("have"))
    whole = market[0].agg(F.count("*").cast("string").alias("want"))
    counts.append(whole.crossJoin(F.broadcast(keys)).select(F.lit("market keys").alias("check"), "want", "have"))

    def by_token(rows: DataFrame, side: str) -> DataFrame:
        sums = rows.groupBy("token").agg(F.count("*").alias("n"), F.count_distinct("tx_hash", "tx_seq").alias("keys"), *limb_sums(F.col("value_raw")))
        limbs = F.concat_ws(" ", *[F.col(f"limb{i}").cast("string") for i in range(5)])
        return sums.select("token", F.struct(F.col("n").cast("string").alias("rows"), F.col("keys").cast("string").alias("keys"), limbs.alias("values")).alias(side))

    rolled = daily.groupBy("token").agg(F.sum("transfers").cast("string").alias("rolled"))
    both = by_token(transfers[0], "want").join(by_token(transfers[1], "have"), "token", "full").join(rolled, "token", "left")
    cells = [
        F.struct(F.concat("token", F.lit(f" {name}")).alias("check"), F.col(f"want.{want}").alias("want"), have.alias("have"))
        for name, want, have in (
            ("rows", "rows", F.col("have.rows")), ("keys", "rows", F.col("have.keys")), ("values", "values", F.col("have.values")), ("rollup", "rows", F.col("rolled"))
        )
    ]
    counts.append(both.select(F.inline(F.array(*cells))))
    passed = F.col("want").eqNullSafe(F.col("have"))
    return reduce(DataFrame.unionByName, counts).select("check", passed.alias("passed"), F.concat_ws(" / ", "want", "have").alias("detail"))
