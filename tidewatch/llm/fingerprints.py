"""Operator 2: SimHash document fingerprints, in DataFrame operations.

The distinct white-space terms of the lower-cased text vote on 64 bits, each
with its weight (its length less two, 1 to 15) for or against as its XXH64 bit
is set or not; a bit is one if the weighted votes for it outweigh. Votes are
summed sixteen bits to a lane, four lanes to a long, in chunks small enough that
no lane overflows; so a term costs sixteen additions inside generated code.

`near` finds all pairs of fingerprints within a Hamming radius by permuted block
tables (Manku et al. 2007): the bits are cut into blocks; two fingerprints
within radius r agree on all but r blocks, so in the table whose leading blocks
are those they meet. A pair is kept in the first table that shows it.

The next document, in descending doc_id, is found without ordering all rows in
one place: ids are cut into ranges of about equal count, each range is ordered
alone, and the last row of a range takes the first of the next range. Rows of
one id are ordered by the CRC-32 of their text, then by the text, so an id with
many rows, or the rows of a null id, are cut into ranges as well.

Null texts count as empty; an empty text has fingerprint zero. Null ids come
last in the order; repeated rows are fingerprinted each. One row is its own
next. Lower-casing is Spark's, of all letters. Only doc_id and text are read, so
other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm import common

MOST_WEIGHT, CHUNK = 15, 4096  # CHUNK * MOST_WEIGHT fits a lane of 16 bits
RANGE_BYTES, COARSE = 2 << 20, 64
RADIUS, SEARCH_EVERY = 3, 20
_LANES = 0x0001000100010001


def terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[\x20\x09-\x0D]+"))


def weight(term: Column) -> Column:
    return F.least(F.greatest(F.char_length(term) - 2, F.lit(1)), F.lit(MOST_WEIGHT)).cast("long")


def fingerprints(rows: DataFrame, *, key: list[str], text: str, out: str = "fingerprint") -> DataFrame:
    """key and the fingerprint (long) of each key's text. Where rows are dealt
    by a part of the key already, nothing is shuffled again."""
    lanes = [f"_l{i}" for i in range(16)]
    exploded = rows.select(*key, F.posexplode_outer(terms(F.coalesce(text, F.lit(""))))).select(
        *key,
        F.coalesce(F.floor(F.col("pos") / CHUNK), F.lit(0)).cast("int").alias("_chunk"),
        F.xxhash64("col").alias("_h"),
        F.when(F.coalesce(F.col("col"), F.lit("")) == "", F.lit(0).cast("long")).otherwise(weight(F.col("col"))).alias("_w"),
    )
    spread = [
        F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(_LANES)) * F.col("_w")).alias(lanes[i]) for i in range(16)
    ]
    chunks = exploded.groupBy(*key, "_chunk").agg(F.sum("_w").alias("_all"), *spread)
    votes = [
        F.sum(F.shiftrightunsigned(lanes[b % 16], 16 * (b // 16)).bitwiseAND(F.lit(0xFFFF))).alias(f"_v{b}") for b in range(64)
    ]
    voted = chunks.groupBy(*key).agg(F.sum("_all").alias("_all"), *votes)
    bits = F.lit(0).cast("long")
    for b in range(64):
        one = F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")
        bits = bits.bitwiseOR(F.when(2 * F.col(f"_v{b}") > F.col("_all"), one).otherwise(F.lit(0).cast("long")))
    return voted.select(*key, bits.alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near(
    queries: DataFrame, prints: DataFrame, *, radius: int = RADIUS, blocks: int = 6, column: str = "fingerprint", carry: Sequence[str] = ()
) -> DataFrame:
    """(query, found) of all pairs of distinct values within the radius, a value
    itself among its own. carry: further columns of prints to come along; its
    values must then be distinct already."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("radius must lie below the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]

    def block(fp: Column, i: int) -> Column:
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))

    chosen = list(combinations(range(blocks), blocks - radius))

    def tables(df: DataFrame, name: str, more: Sequence[str] = ()) -> DataFrame:
        fp = F.col(column)
        keys = [F.struct(F.lit(t).alias("t"), F.xxhash64(*[block(fp, i) for i in c]).alias("k")) for t, c in enumerate(chosen)]
        known = df.where(fp.isNotNull()).select(column, *more)
        return (known if more else known.distinct()).select(F.inline(F.array(*keys)), fp.alias(name), *more)

    a, b = F.col("query"), F.col("found")
    first = None
    for t, c in enumerate(chosen):
        same = F.lit(True)
        for i in c:
            same = same & (block(a, i) == block(b, i))
        first = F.when(same, F.lit(t)) if first is None else first.when(same, F.lit(t))
    pairs = tables(queries, "query").join(tables(prints, "found", carry).hint("merge"), ["t", "k"])
    return pairs.where(F.bit_count(a.bitwiseXOR(b)) <= radius).where(first == F.col("t")).select("query", "found", *carry)


def in_ranges(docs: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """docs with _slot and _range, numbers that grow with (doc_id, _crc), and
    _crc. Ranges hold about equally many rows: the slots lie between a fixed
    number of quantiles of the ids and are cut evenly by id; an id that takes up
    two quantiles, and null, is a slot of its own, cut evenly by _crc."""
    row = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.percentile_approx("doc_id", [i / COARSE for i in range(COARSE + 1)], 10_000).alias("cuts"),
    ).first()
    found = list(row["cuts"] or [0])
    cuts = sorted(set(found))
    hot = [c for c in cuts if found.count(c) > 1] or [None]
    fine = max(1, -(-int(row["bytes"] or 0) // (range_bytes * COARSE)))
    at = F.greatest(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))), F.lit(1))
    ends = F.array(*map(F.lit, [*cuts, cuts[-1] + 1]))
    low, high = ends[at - 1], ends[at]
    alone = F.col("doc_id").isNull() | F.coalesce(F.col("doc_id").isin(hot), F.lit(False))
    slot = F.when(F.col("doc_id").isNull(), 0).otherwise(2 * at + F.when(alone, 0).otherwise(1)).cast("long")
    share = F.when(alone, F.col("_crc") / F.lit(float(1 << 32))).otherwise((F.col("doc_id") - low) / (high - low))
    parts = F.when(alone, fine * COARSE).otherwise(fine)
    within = F.least(F.greatest(F.floor(share * parts), F.lit(0)), parts - 1)
    held = docs.withColumn("_crc", F.crc32("text")).withColumn("_slot", slot)
    return held.withColumn("_range", F.col("_slot") * (fine * COARSE) + within)


def with_next(docs: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """_slot, _range, _row, doc_id, text and the text of the next document, _next."""
    ranged = in_ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), range_bytes=range_bytes)
    inside = W.partitionBy("_range").orderBy(F.desc("doc_id"), F.desc("_crc"), F.desc("text"))
    own = ranged.select(
        "_slot", "_range", "doc_id", "text", F.row_number().over(inside).alias("_row"), F.lead("text").over(inside).alias("_lead")
    )
    tops = ranged.groupBy("_range").agg(F.max(F.struct("doc_id", "_crc", "text")).alias("top"), F.first("_slot").alias("_slot"))
    return _after(own, tops.select("_slot", "_range", F.col("top.text").alias("_top")), "_lead", "_top", "_next")


def _after(rows: DataFrame, tops: DataFrame, lead: str, top: str, out: str) -> DataFrame:
    """rows with out: lead, or for the last row of a range the top of the range
    below, and of the lowest range that of the highest. Ranges are ordered slot
    by slot; only the slots, a fixed number, are ordered in one place."""
    slots = tops.groupBy("_slot").agg(F.max("_range").alias("_highest"))
    down = W.partitionBy(F.lit(0)).orderBy(F.desc("_slot"))
    whole = down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    onward = slots.select("_slot", F.coalesce(F.lead("_highest").over(down), F.max("_highest").over(whole)).alias("_onward"))
    steps = tops.select("_slot", "_range").join(F.broadcast(onward), "_slot")  # a row for each slot
    lower = F.lead("_range").over(W.partitionBy("_slot").orderBy(F.desc("_range")))
    steps = steps.select("_range", F.coalesce(lower, "_onward").alias("_below"))
    below = steps.join(tops.select(F.col("_range").alias("_below"), top), "_below").select("_range", top)
    joined = rows.join(below, "_range", "left")
    return joined.withColumn(out, F.coalesce(lead, top)).drop(lead, top)


def document_prints(docs: DataFrame) -> DataFrame:
    """A settled table of each document and its edited text: _slot, _range, _row,
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (long)."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half))
    both = with_next(docs).select(
        "_slot", "_range", "_row", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited")
    )
    key = ["_range", "_slot", "_row", "doc_id", "n_chars", "edited_sha256", "_edited"]
    sides = both.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *key[:-1],
        F.expr("inline(array(named_struct('_edited', false, 'body', text), named_struct('_edited', true, 'body', edited)))"),
    )
    prints = fingerprints(sides, key=key, text="body")
    side = lambda e: F.max(F.when(F.col("_edited") == e, F.col("fingerprint")))
    return common.settle(
        prints.groupBy(*key[:-1]).agg(side(False).alias("fingerprint"), side(True).alias("edited_fingerprint")), "prints"
    )


def near_counts(rows: DataFrame, queries: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, near_docs): for each fingerprint of the queries the other
    rows within the radius. Equal fingerprints are counted before pairs are made."""
    size = rows.groupBy("fingerprint").agg(F.count("*").alias("_n"))
    found = near(queries, size, radius=radius, carry=["_n"]).groupBy("query").agg((F.sum("_n") - 1).alias("near_docs"))
    return found.withColumnRenamed("query", "fingerprint")


def fingerprint_documents(docs: DataFrame, *, search_every: int = SEARCH_EVERY) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and near_docs: how many other documents lie within
    RADIUS bits, for the query set, ids that search_every divides; else null."""
    rows = document_prints(docs)
    asked = F.col("doc_id") % search_every == 0
    counts = near_counts(rows, rows.where(asked).select("fingerprint"))
    inside = W.partitionBy("_range").orderBy("_row")
    lead = rows.withColumn("_lead", F.lead("fingerprint").over(inside))
    tops = rows.where("_row = 1").select("_slot", "_range", F.col("fingerprint").alias("_top"))
    full = _after(lead, tops, "_lead", "_top", "_next")
    full = full.withColumn("_asked", F.when(asked, F.col("fingerprint")))
    full = full.join(counts.withColumnRenamed("fingerprint", "_asked"), "_asked", "left")
    fp = F.col("fingerprint")
    return full.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(fp).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(fp, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(fp, F.col("_next")).alias("near_next"),
        "near_docs",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(common.table(spark, sf_dir, "documents"))
