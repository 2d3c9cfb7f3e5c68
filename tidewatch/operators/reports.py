"""Report queries, the dashboard and the written report as sections of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidewatch.functions.stats import scaled_round, significant
from tidewatch.operators.quality import impossible_turnover
from tidewatch.operators.scoring import METHODS


def status_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy("status").agg(F.count("*").alias("coins"), F.sum("days").alias("days"))


def glitches_removed(flagged: DataFrame, quality: DataFrame) -> DataFrame:
    ok = quality.where(F.col("status") == "ok").select("coin_id")
    return flagged.join(ok, "coin_id", "left_semi").agg(
        F.count_if("volume_glitch").alias("days"),
        F.count_distinct(F.when(F.col("volume_glitch"), F.col("coin_id"))).alias("coins"),
    )


def turnover_summary(clean_rows: DataFrame, times: Sequence[float] = (1, 5, 10)) -> DataFrame:
    """Days and entities beyond each multiple, from one scan at the least."""
    odd = impossible_turnover(clean_rows, times=min(times))
    one = odd.agg(
        *[F.count_if(F.col("volume") > x * F.col("market_cap")).alias(f"d{i}") for i, x in enumerate(times)],
        *[F.count_distinct(F.when(F.col("volume") > x * F.col("market_cap"), F.col("coin_id"))).alias(f"c{i}") for i, x in enumerate(times)],
    )
    cells = [F.struct(F.lit(float(x)).alias("times"), F.col(f"d{i}").alias("days"), F.col(f"c{i}").alias("coins")) for i, x in enumerate(times)]
    return one.select(F.inline(F.array(*cells)))


def turnover_leaders(clean_rows: DataFrame, *, times: float = 5, most: int = 5) -> DataFrame:
    odd = impossible_turnover(clean_rows, times=times)
    days = odd.groupBy("coin_id").agg(F.count("*").alias("days"), F.max("turnover").alias("peak"))
    return days.orderBy(F.desc("days"), "coin_id").limit(most)


def turnover_days(clean_rows: DataFrame, *, times: float = 5, most: int = 40) -> DataFrame:
    odd = impossible_turnover(clean_rows, times=times)
    move = (F.exp("log_return") - 1).alias("move")
    return odd.select("coin_id", "date", "volume", "market_cap", "turnover", move).orderBy(F.desc("turnover"), "coin_id", "date").limit(most)


def median_turnover(clean_rows: DataFrame) -> DataFrame:
    return clean_rows.where(F.col("market_cap") > 0).agg(F.median(F.col("volume") / F.col("market_cap")).alias("median_turnover"))


def fat_tails(features: DataFrame, *, beyond: float = 3) -> DataFrame:
    known = features.where(F.col("return_z").isNotNull())
    return known.agg(F.try_divide(F.count_if(F.abs("return_z") > beyond), F.count("*")).alias("share"), F.count("*").alias("rows"))


def token_totals(transfers: DataFrame) -> DataFrame:
    """Rows, distinct addresses of both columns and span per token; rows are
    counted before addresses are unfolded."""
    counted = transfers.groupBy("token").agg(
        F.count("*").alias("transfers"), F.min("block_time").alias("first"), F.max("block_time").alias("last")
    )
    seen = transfers.select("token", F.explode(F.array("from_address", "to_address")).alias("address"))
    return counted.join(seen.groupBy("token").agg(F.count_distinct("address").alias("addresses")), "token")


def function_shares(transfers: DataFrame, *, token: str, most: int = 4) -> DataFrame:
    """What share of a token's transfers each function makes."""
    own = transfers.where(F.col("token") == token)
    named = own.groupBy(F.split_part("function_name", F.lit("("), F.lit(1)).alias("function")).agg(F.count("*").alias("n"))
    total = own.agg(F.count("*").alias("all"))
    shares = named.crossJoin(F.broadcast(total)).select("function", (F.col("n") / F.col("all")).alias("share"))  # one row
    return shares.orderBy(F.desc("share"), "function").limit(most)


def round_trip_summary(token_features: DataFrame) -> DataFrame:
    return token_features.groupBy("token").agg(F.avg("rt_share").alias("rt_share"), F.median("transfers").alias("median_transfers"))


def flagged_per_day(scored: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """Median over days of the share of entities that each method flags."""
    daily = scored.groupBy("date").agg(*[F.avg(F.col(f"{m}_flag").cast("double")).alias(m) for m in methods])
    return daily.agg(*[F.median(m).alias(m) for m in methods])


def vote_totals(scored: DataFrame, method: str = "zscore") -> DataFrame:
    return scored.agg(
        F.count("*").alias("rows"),
        F.count_distinct("coin_id").alias("coins"),
        F.count_if(f"{method}_flag").alias("flags"),
        F.count_if(F.col("votes") >= 2).alias("votes2"),
        F.count_if(F.col("votes") == 3).alias("votes3"),
        F.min(F.when(F.col(f"{method}_flag"), F.col(f"{method}_score"))).alias("cutoff"),
    )


def profile(raw: DataFrame) -> DataFrame:
    """Rows, nulls, span, gaps and duplicate keys of each daily series."""
    by_day = W.partitionBy("coin_id").orderBy("date")
    step = raw.withColumn("_gap", F.date_diff("date", F.lag("date").over(by_day)))
    return step.groupBy("coin_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("price").isNull()).alias("null_prices"),
        F.count_if(F.col("market_cap").isNull()).alias("null_caps"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if(F.col("_gap") > 1).alias("gaps"),
        F.count_if(F.col("_gap") == 0).alias("duplicate_days"),
    )


def daily_resample(transfers: DataFrame) -> DataFrame:
    """Transfers per token and day, days without any included."""
    daily = transfers.groupBy("token", F.to_date("block_time").alias("day")).agg(F.count("*").alias("n"))
    spans = daily.groupBy("token").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = spans.select("token", F.explode(F.sequence("a", "b")).alias("day"))
    return spine.join(daily, ["token", "day"], "left").fillna(0, ["n"])


def series_on_spine(raw: DataFrame, values: Sequence[str] = ("price", "volume"), *, digits: int = 5) -> DataFrame:
    """Each entity's values as arrays over all days of the table, null on its gaps."""
    span = raw.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    wanted = raw.select("coin_id").distinct()
    grid = wanted.crossJoin(F.broadcast(spine))  # a row per calendar day
    dense = grid.join(raw.select("coin_id", "date", *values), ["coin_id", "date"], "left")
    cells = F.array_sort(F.collect_list(F.struct("date", *[significant(F.col(v), digits).alias(v) for v in values])))
    held = dense.groupBy("coin_id").agg(cells.alias("_s"))
    return held.select("coin_id", *[F.col(f"_s.{v}").alias(v) for v in values])


def notable_first(coins: DataFrame, notable: Sequence[str], *, top: int = 150) -> DataFrame:
    """The best-ranked entities, then the notable ones among the rest, in order."""
    ranked = coins.where(F.col("market_cap_rank").isNotNull()).orderBy("market_cap_rank", "coin_id").limit(top)
    place = F.row_number().over(W.orderBy("market_cap_rank", "coin_id"))
    best = ranked.select("coin_id", place.alias("place"))
    extra = [F.struct(F.lit(c).alias("coin_id"), F.lit(top + i + 1).alias("place")) for i, c in enumerate(notable)]
    more = coins.sparkSession.range(1).select(F.inline(F.array(*extra))).join(coins.select("coin_id"), "coin_id", "left_semi")
    return best.unionByName(more).groupBy("coin_id").agg(F.min("place").alias("place"))


def totals(raw: DataFrame, quality: DataFrame, clean_rows: DataFrame, features: DataFrame, typed: DataFrame, transfers: DataFrame, labels: DataFrame) -> DataFrame:
    """The report's head figures in one row."""
    moved = transfers.agg(F.count("*").alias("transfers"))
    known = transfers.select(F.explode(F.array("from_address", "to_address")).alias("address")).agg(F.count_distinct("address").alias("addresses"))
    votes = vote_totals(typed).withColumnsRenamed({"rows": "modelled_rows", "coins": "modelled_coins", "flags": "flags_per_method"})
    parts = [
        raw.agg(F.count_distinct("coin_id").alias("coins"), F.count("*").alias("market_rows")),
        quality.agg(F.count_if(F.col("status") == "ok").alias("clean_coins")),
        votes,
        moved,
        known,
        labels.agg(F.count("*").alias("labelled"), F.count_if("is_contract").alias("contracts")),
        fat_tails(features).select(F.col("share").alias("fat_tail_share")),
        median_turnover(clean_rows),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out


#: Section -> its rows and the columns that name one.
Sections = dict[str, tuple[DataFrame, Sequence[str]]]


def documents(sections: Sections) -> DataFrame:
    """(section, item, body): a JSON object for each row of each section."""
    out = None
    for name, (rows, item) in sections.items():
        body = F.to_json(F.struct(*rows.columns))
        part = rows.select(F.lit(name).alias("section"), _item(item).alias("item"), body.alias("body"))
        out = part if out is None else out.unionByName(part)
    return out


def _item(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def figures(sections: Sections, *, digits: int = 6) -> DataFrame:
    """(section, item, field, value): every number of the sections a row."""
    out = None
    for name, (rows, item) in sections.items():
        numbers = [f.name for f in rows.schema.fields if isinstance(f.dataType, NumericType) and f.name not in item]
        cells = [F.struct(F.lit(c).alias("field"), scaled_round(F.col(c).cast("double"), digits).alias("value")) for c in numbers]
        part = rows.select(F.lit(name).alias("section"), _item(item).alias("item"), F.inline(F.array(*cells)))
        out = part if out is None else out.unionByName(part)
    return out


def dashboard(
    raw: DataFrame, flagged: DataFrame, quality: DataFrame, clean_rows: DataFrame, typed: DataFrame, transfers: DataFrame,
    token_features: DataFrame, *, times: Sequence[float] = (1, 5, 10), digits: int = 5,
    values: Sequence[str] = ("price", "volume"),
) -> Sections:
    """The sections of the dashboard, for documents() or figures(). Series have
    a row for an entity's day, so nothing gathers a whole table in one place."""
    from tidewatch.operators import compare

    series = raw.select("coin_id", "date", *[significant(F.col(c), digits).alias(c) for c in values])
    daily = ("transfers", "unique_addresses", "new_addresses", "rt_share", "top10_sender_share", "large_transfers", "hub_share")
    return {
        "status": (status_counts(quality), ["status"]),
        "glitches": (glitches_removed(flagged, quality), []),
        "turnover": (turnover_summary(clean_rows, times), ["times"]),
        "turnover_days": (turnover_days(clean_rows, times=sorted(times)[len(times) // 2]), ["coin_id", "date"]),
        "agreement": (compare.agreement(typed), ["a", "b"]),
        "mix": (compare.method_mix(typed), ["method"]),
        "strongest": (compare.strongest_agreed(typed).select("coin_id", "date", "type", "votes", "volume"), ["coin_id", "date", "type"]),
        "wash": (compare.wash_candidates(typed).select("coin_id", "date", "volume").orderBy(F.desc("volume"), "coin_id", "date").limit(40), ["coin_id", "date"]),
        "votes": (vote_totals(typed), []),
        "tokens": (token_totals(transfers), ["token"]),
        "activity": (token_features.select("token", "day", *daily), ["token", "day"]),
        "series": (series, ["coin_id", "date"]),
    }


def insights(
    raw: DataFrame, flagged: DataFrame, quality: DataFrame, clean_rows: DataFrame, features: DataFrame, typed: DataFrame, transfers: DataFrame,
    labels: DataFrame, token_features: DataFrame, recalls: DataFrame, hits: DataFrame, *, token: str, times: Sequence[float] = (1, 5, 10),
) -> Sections:
    """The written report's numbers: data, quality, tails, turnover, transfers,
    agreement, recall of planted anomalies and events."""
    from tidewatch.operators import compare
    from tidewatch.operators.transfers import contract_share, mutual_pairs

    tails = fat_tails(features).select("share")
    return {
        "data": (raw.agg(F.count_distinct("coin_id").alias("coins"), F.count("*").alias("rows")), []),
        "transfers": (token_totals(transfers), ["token"]),
        "status": (status_counts(quality), ["status"]),
        "glitches": (glitches_removed(flagged, quality), []),
        "tails": (tails.withColumn("times_normal", F.col("share") / 0.0027), []),
        "votes": (vote_totals(typed), []),
        "median_turnover": (median_turnover(clean_rows), []),
        "turnover": (turnover_summary(clean_rows, times), ["times"]),
        "leaders": (turnover_leaders(clean_rows, times=sorted(times)[len(times) // 2]), ["coin_id"]),
        "pairs": (contract_share(mutual_pairs(transfers), labels), ["token"]),
        "round_trips": (round_trip_summary(token_features), ["token"]),
        "functions": (function_shares(transfers, token=token), ["function"]),
        "agreement": (compare.agreement(typed).where("a < b"), ["a", "b"]),
        "recall": (recalls.where(F.col("type").isin("all", "combo")), ["type", "strength"]),
        "events": (hits.select("event", "rows", *[F.col(m).cast("int").alias(m) for m in METHODS if m in hits.columns]), ["event"]),
    }
