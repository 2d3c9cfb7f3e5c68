"""Operator 8: best-fit packing with Martello-Toth dominance reduction.

Packing is planned on the histogram of lengths, which has at most `capacity`
entries however large the corpus is: first dominating sets are fixed for all
items of a length at once, then the rest is packed best fit, longest first, by
groups of sequences that look alike. The plan says, for each length, which
ranks go to which sequences; items get their rank within their length by a
salted count, so that a length with a third of all rows is spread over tasks.

Null texts count as empty: one piece, the separator. Repeated rows are packed
each, and rows of a null id like any other. A very long text is encoded in
strides and gives as many pieces as it fills. Only doc_id and text are read, so
other columns may have any name; where items are packed themselves, columns
named sequence_id or offset give way to the results. Items of a null or non-positive length, or one above the capacity, are an
error of the caller and raise; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm import common
from tidewatch.llm.wordbpe import encoder

CAPACITY = 2048
SEPARATOR = 0
#: Rows that are worked on at a time, of those that Spark sends together.
ROWS = 1000
#: (number of sequences, the lengths in each)
Group = tuple[int, tuple[int, ...]]


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Fixes sets that provably dominate every other sequence of their longest
    item: the item alone if nothing fits beside it; with the one item that
    fills it up; with the longest that fits, if no two fit beside it or no two
    that fit outweigh that one and no three fit. Whole counts are fixed at a
    time: taking items away makes no further pair or triple fit, so a reason
    holds until one of its lengths is used up. Hence every step ends a length,
    however many items there are. Returns the groups and what is left."""
    left = {k: n for k, n in counts.items() if n > 0}
    fixed: list[Group] = []

    def fix(times: int, *lengths: int) -> None:
        fixed.append((times, lengths))
        for x in lengths:
            left[x] -= times
            if not left[x]:
                del left[x]

    def smallest(n: int, without: int) -> list[int]:
        out: list[int] = []
        for x in sorted(left):
            out += [x] * min(n - len(out), left[x] - (x == without))
            if len(out) == n:
                break
        return out

    def heaviest_pair(room: int, without: int) -> int:
        """The most that two items fill of the room, one `without` put aside."""
        lengths = sorted(x for x in left if x <= room and left[x] > (x == without))
        most, i, j = 0, 0, len(lengths) - 1
        while i <= j:
            a, b = lengths[i], lengths[j]
            if a + b > room:
                j -= 1
                continue
            if i < j or left[a] - (a == without) > 1:
                most = max(most, a + b)
            i += 1
        return most

    for big in sorted(left, reverse=True):
        while left.get(big):
            room = capacity - big
            others = smallest(3, big)
            if not others or others[0] > room:
                fix(left[big], big)
                continue
            if room in left and (room != big or left[big] > 1):
                fix(left[big] // 2 if room == big else min(left[big], left[room]), big, room)
                continue
            best = max(x for x in left if x <= room and left[x] > (x == big))
            if len(others) > 1 and others[0] + others[1] <= room:
                if len(others) > 2 and sum(others) <= room:
                    break
                if heaviest_pair(room, big) > best:
                    break
            if best == big:
                fix(left[big] // 2, big, big)
            else:
                fix(min(left[big], left[best]), big, best)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit, longest first, on groups of equal sequences. The fullest that
    still takes an item becomes fuller yet, so it takes all that fit before the
    next one gets any; whole groups are filled that way at a time."""
    open_: dict[int, list[Group]] = defaultdict(list)

    def fill(room: int, n: int, held: tuple[int, ...], length: int, todo: int) -> int:
        per = room // length
        full, part = (n, 0) if n * per <= todo else divmod(todo, per)
        for times, k in ((full, per), (1 if part else 0, part), (n - full - bool(part), 0)):
            if times:
                open_[room - k * length].append((times, held + (length,) * k))
        return todo - full * per - part

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        for room in sorted(r for r in open_ if r >= length):
            groups = open_.pop(room)
            for n, held in groups:
                todo = fill(room, n, held, length, todo)
        if todo:
            fill(capacity, -(-todo // (capacity // length)), (), length, todo)
    return [g for groups in open_.values() for g in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    if any(not isinstance(k, int) or not 0 < k <= capacity for k in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    fixed, left = reduce_dominated(counts, capacity)
    return fixed + best_fit(left, capacity)


def placements(groups: list[Group]) -> dict[str, np.ndarray]:
    """For each length the runs of ranks that go to consecutive sequences, in
    the order of (length, rank)."""
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for n, lengths in groups:
        at = 0
        for x in lengths:
            rows.append((x, taken[x], base, at))
            taken[x] += n
            at += x
        base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


def pack(items: DataFrame, *, key: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """items with sequence_id and offset. key: columns that order items of one
    length; rows equal in all of them are interchangeable. items is read more
    than once: give a settled table."""
    spark = items.sparkSession
    counts = {r[length]: r["n"] for r in items.groupBy(length).agg(F.count("*").alias("n")).collect()}
    runs = placements(plan(counts, capacity))

    salts = max(32, common.shuffle_partitions(spark))
    salted = items.drop("sequence_id", "offset").withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int"))
    own = W.partitionBy(length, "_salt").orderBy(*key)
    ranked = salted.withColumn("_rank", F.row_number().over(own))
    before = W.partitionBy(length).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        salted.groupBy(length, "_salt")
        .agg(F.count("*").alias("n"))
        .select(length, "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    )
    ranked = ranked.join(starts, [length, "_salt"]).withColumn("_rank", F.col("_start") + F.col("_rank") - 1)
    ranked = ranked.select(*[c for c in items.columns if c not in ("sequence_id", "offset")], "_rank")
    schema = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = ranked.select(*[f.name for f in schema], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = 1 << 44
        keys = runs["length"] * stride + runs["rank"]
        for b in batches:
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, b.column(length).to_numpy(zero_copy_only=False) * stride + rank, "right") - 1
            keep = [c for c in b.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in keep),
                    pa.array(runs["sequence"][i] + rank - runs["rank"][i]),
                    pa.array(runs["offset"][i]),
                ],
                names=[*keep, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def cut_documents(
    docs: DataFrame, path: str, *, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of the
    documents' tokens, each document ended by the separator. Only a document
    longer than the capacity has several pieces."""
    end = separator.to_bytes(4, "little")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, by_library=True)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            packed = bpe.packed([t or "" for t in batch.column("text").to_pylist()])
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, b in enumerate(packed):
                b += end
                for k, at in enumerate(range(0, len(b), 4 * capacity)):
                    part = b[at : at + 4 * capacity] if len(b) > 4 * capacity else b
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, np.int32))
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, *, capacity: int = CAPACITY) -> DataFrame:
    pieces = common.settle(cut_documents(docs, path, capacity=capacity), "pieces")
    return pack(pieces, key=["doc_id", "piece", "ids_crc32"], capacity=capacity)


def op8_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its place in it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(common.table(spark, sf_dir, "documents"), path)
