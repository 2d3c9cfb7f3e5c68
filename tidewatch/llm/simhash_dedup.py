"""Operator 10: near-duplicate detection by SimHash with pigeonring filtering.

Fingerprint: XXH64 (seed 42) of every 3-word shingle of the lower-cased text,
repeats included; a bit is one if more than half the hashes have it. Documents
with one fingerprint form a class; classes link at `radius` or fewer differing
bits, and the connected components are the near-duplicate groups.

Links are found by the pigeonring principle (Qin and Xiao 2018). The 64 bits
are a ring of four segments. If two fingerprints differ in at most r bits in
all, then from some segment on every chain of l consecutive segments has at most
l*r/4 differences. For r = 3 that is none in the first segment, one in the first
two, two in the first three. So the first two segments of the chain are the
join key: one side gives its own, the other gives its own and each with one
zero of the second segment set, which meets every pair once from its smaller
side. The third segment's budget and the full distance are checked in the join.
Two fingerprints that share no such key cannot be within the radius.

Where copies are asked for by similarity, the default of the pipeline's stage,
these links are candidates only: each is held against the shingle sets
themselves, and what lies beyond the radius is found by `jaccard`, so that the
groups are those of every pair that reaches the similarity.

Null texts count as empty; texts without words have fingerprint zero and link
like any other. Repeated rows fall into one class. Rows of a null id take part
as a class of their own id: component_id is the smallest non-null id of its
component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import common

SEED, SHINGLE, RADIUS, SEGMENTS = 42, 3, 3, 4
WIDTH = 64 // SEGMENTS


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hash of every shingle in order; none of a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.array([], np.uint64)
    digest, n = xxhash.xxh64_intdigest, len(words)
    whole = b" ".join(words)
    if n <= shingle:
        return np.array([digest(whole, SEED)], np.uint64)
    ends = list(accumulate(map(len, words), lambda at, x: at + x + 1))
    starts = [0, *(e + 1 for e in ends)]
    return np.array([digest(whole[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    return majority(shingle_hashes(text, shingle))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """doc_id and the fingerprint as long; reads only these two columns."""

    return _printed(docs.select("doc_id", text), out)


def _printed(rows: DataFrame, out: str, shingle: int = SHINGLE) -> DataFrame:
    """The first column of rows, and the fingerprint of the text in its second."""
    key = rows.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            values = pa.array([fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), values], names=[key, out])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"{key} {kind}, {out} long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - WIDTH * (i % SEGMENTS + 1)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def links(prints: DataFrame) -> DataFrame:
    """All pairs (a, b) of the given distinct fingerprints (column `f`) within
    RADIUS differing bits, each once or a few times."""
    chains = [
        F.struct(
            F.lit(i).alias("i"),
            F.shiftleft(_segment(F.col("f"), i), WIDTH).bitwiseOR(_segment(F.col("f"), i + 1)).alias("k"),
        )
        for i in range(SEGMENTS)
    ]
    index = prints.select(F.inline(F.array(*chains)), F.col("f").alias("b"))
    flips = F.array(*[F.lit(1 << j).cast("long") for j in range(WIDTH)])
    probe = (
        prints.select(F.inline(F.array(*chains)), F.col("f").alias("a"))
        .select("i", "a", "k", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)).alias("flip"))
        .where(F.col("k").bitwiseAND(F.col("flip")) == 0)
        .select("i", F.col("k").bitwiseOR(F.col("flip")).alias("k"), "a", (F.col("flip") == 0).alias("same"))
    )
    differ = F.col("a").bitwiseXOR(F.col("b"))
    third = F.lit(0)
    for i in range(SEGMENTS):
        third = F.when(F.col("i") == i, F.bit_count(_segment(differ, i + 2))).otherwise(third)
    spent = F.when(F.col("same"), 0).otherwise(1)
    return (
        probe.join(index.hint("merge"), ["i", "k"])  # sizes before the unfolding say little
        .where(~F.col("same") | (F.col("a") < F.col("b")))
        .where(spent + third <= 2)
        .where(F.bit_count(differ) <= RADIUS)
        .select("a", "b")
    )


def with_groups(classes: DataFrame) -> DataFrame:
    """classes (column `f`, distinct fingerprints) with their components `g`."""
    edges = common.settle(links(classes.select("f")).distinct(), "links")
    groups = common.connected_components(edges, src="a", dst="b")
    return classes.join(groups, F.col("f") == F.col("node"), "left").select(*classes.columns, F.coalesce("component", "f").alias("g"))


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (long), component_id of every row of docs."""
    prints = common.settle(fingerprints(docs), "simhash")
    classes = common.settle(prints.groupBy(F.col("fingerprint").alias("f")).agg(F.min("doc_id").alias("least")), "classes")
    named = with_groups(classes)
    least = named.groupBy("g").agg(F.min("least").alias("component_id"))
    member = named.join(least, "g").select("f", "component_id")
    return prints.join(member, F.col("fingerprint") == F.col("f")).select("doc_id", "fingerprint", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    return components(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def survivors(grouped: DataFrame) -> DataFrame:
    """Of the rows `doc` of each component `g` the one of the smallest doc_id,
    nulls last, then of the smallest text; the columns of doc."""
    first = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("doc.text"))
    return grouped.groupBy("g").agg(F.min_by("doc", first).alias("doc")).select("doc.*")


def keep_one(docs: DataFrame, *, similarity: tuple[int, int] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """One row of each near-duplicate group, chosen among rows: that of the
    smallest doc_id, nulls last, then of the smallest text. A group of null ids
    keeps one too, and texts that share an id are judged each. Columns as given.

    Groups are those of RADIUS differing bits, or with a similarity (numerator,
    denominator) those of all pairs whose sets of shingles reach it."""
    if similarity is not None:
        from tidewatch.llm import jaccard

        return jaccard.keep_one(docs, similarity=similarity, shingle=shingle)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    prints = common.settle(_printed(whole, "fingerprint", shingle), "simhash-rows")
    groups = with_groups(prints.select(F.col("fingerprint").alias("f")).distinct()).select("f", "g")
    return survivors(prints.join(groups, F.col("fingerprint") == F.col("f")).select("doc", "g"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
