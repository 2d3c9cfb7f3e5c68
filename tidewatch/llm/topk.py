"""Operator 4: exact top-k search by MaxScore.

Rows are packed into shards of at most SHARD rows as they are read; a shard
holds the postings of each term and bounds of each term's values. A stated
query set is packed into blocks of at most BLOCK queries. Every block meets
every group of shards once, on the key (group, block). For each query the terms
are ordered by the most they can add in the shard. Those of least weight whose
sum stays below the k-th score so far are non-essential: a row that only they
touch cannot enter. Essential postings are added up; the rest is probed, the
heaviest first, for rows that can still compete. Each group gives k rows for a
query, and the groups' rows are merged. Work is queries times rows by contract;
a shard is sent once for BLOCK queries, so a byte that is sent is met by some
thousand multiplications.

Terms of a vector are its components, as floor(256 x) of the double x, however
large: where a sum might leave 64 bits, the shard is searched with integers of
any size. Ranks follow the exact sums; a score beyond the range of a long is
given as the range's end. Vectors that are null or hold a null or non-finite
component take no part, neither as query nor as candidate. Vectors of different
lengths are compared on their common components. Ties go to the smaller id.

Every row is a candidate, so a row that repeats is listed as often as it is
there. Rows of the query's own id are none of its candidates. A query id that
repeats is one query: of its vectors the least, compared by components, is
asked. Candidates without common terms score 0. Null ids take no part. Only the
two columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm import common

SHARD, BLOCK, GROUP = 8192, 1024, 16
SCALE = 256.0
#: Sums below this, as doubles tell, are sure to fit 64 bits.
SAFE = 2.0**61
LONG = 1 << 63


@dataclass
class Shard:
    """Rows of ascending id; row i of columns is term i's postings, dense as
    the terms of vectors are. Zeros are no posting. columns holds int64, or
    Python's integers where one component is too large for them."""

    ids: np.ndarray
    columns: np.ndarray

    def __post_init__(self) -> None:
        some = self.columns.shape[1] > 0
        self.most = np.maximum(self.columns.max(axis=1), 0) if some else np.zeros(len(self.columns), np.int64)
        self.least = np.minimum(self.columns.min(axis=1), 0) if some else np.zeros(len(self.columns), np.int64)
        if not self.large:
            self.size = np.maximum(self.most.astype(np.float64), -self.least.astype(np.float64))

    @property
    def large(self) -> bool:
        return self.columns.dtype == object

    def exact(self) -> Shard:
        return Shard(self.ids, self.columns.astype(object))

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """best: (-score, id) of the k best so far, ascending; the same, with
        this shard's rows."""
        m = min(len(self.columns), len(query))
        if not self.large and (query.dtype == object or np.abs(query[:m].astype(np.float64)) @ self.size[:m] >= SAFE):
            return self.exact().search(query.astype(object), own, k, best)
        q = np.zeros(len(self.columns), self.columns.dtype)
        q[:m] = query[:m]
        bound = np.maximum(q * self.most, q * self.least)
        order = np.argsort(bound, kind="stable")
        if len(best) < k:  # a first threshold from a few whole rows
            few = min(len(self.ids), 4 * k)
            best = self._merge(best, np.arange(few), q @ self.columns[:, :few], own, k)
            done = few
        else:
            done = 0
        floor = -best[-1][0] if len(best) == k else None
        acc = np.zeros(len(self.ids) - done, self.columns.dtype)
        sums = np.cumsum(bound[order])
        split = 0 if floor is None else sum(1 for s in sums.tolist() if s < floor)  # sums rise
        for d in order[split:]:  # essential postings
            if q[d]:
                acc += q[d] * self.columns[d, done:]
        rest = int(sums[split - 1]) if split else 0
        alive = np.arange(len(acc)) if floor is None else np.flatnonzero(acc + rest >= floor)
        score = acc[alive]
        for d in order[:split][::-1]:  # probe the others while competitive
            if not len(alive):
                break
            rest -= int(bound[d])
            if q[d]:
                score = score + q[d] * self.columns[d, done + alive]
            keep = (score + rest >= floor).astype(bool)
            alive, score = alive[keep], score[keep]
        return self._merge(best, done + alive, score, own, k)

    def _merge(self, best: list, rows: np.ndarray, score: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        ids = self.ids[rows]
        other = ids != own
        ids, score = ids[other], score[other]
        if len(ids) > k:
            cut = np.sort(score)[len(score) - k]
            keep = (score >= cut).astype(bool)
            ids, score = ids[keep], score[keep]
        found = sorted(zip((-score).tolist(), ids.tolist(), strict=True))[:k]
        return sorted([*best, *found])[:k]


def usable(vector: Column) -> Column:
    """Whether every component is a finite number."""
    finite = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _integers(y: np.ndarray) -> np.ndarray:
    """256 y, y being multiples of 1/256, in integers of any size."""
    out = np.zeros(y.shape, object)
    for at in np.ndindex(y.shape):
        top, bottom = float(y[at]).as_integer_ratio()
        out[at] = top * 256 // bottom
    return out


def _pack(df: DataFrame, key: str, vector: str, most: int) -> DataFrame:
    """n, wide, ids, data: blocks of at most `most` rows, ordered by id. data is
    the transposed matrix of terms, in int32 or, where one needs more (wide), as
    doubles of a 256th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # ids, lengths, components

        def block() -> pa.RecordBatch:
            ids, lengths, flat = (np.concatenate(x) for x in zip(*held, strict=True))
            data = np.zeros((len(ids), max(int(lengths.max()), 0)))
            data[np.arange(data.shape[1])[None, :] < lengths[:, None]] = flat
            wide = bool(data.size) and float(np.abs(data).max()) >= (1 << 31) / SCALE
            order = np.argsort(ids, kind="stable")
            data = np.ascontiguousarray(data[order].T)
            held.clear()
            return pa.RecordBatch.from_pydict(
                {
                    "n": pa.array([len(ids)], pa.int32()),
                    "wide": pa.array([wide]),
                    "ids": pa.array([ids[order].tobytes()], pa.binary()),
                    "data": pa.array([(data if wide else (data * SCALE).astype(np.int32)).tobytes()], pa.binary()),
                }
            )

        size = 0
        for b in batches:
            column = b.column(1)
            ids, ends = b.column(0).to_numpy(), column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):  # beyond 2^1000 every double is whole
                values = np.where(np.abs(values) < 2.0**1000, np.floor(SCALE * values) / SCALE, values)
            at = 0
            while at < len(ids):
                upto = min(len(ids), at + most - size)
                held.append((ids[at:upto], np.diff(ends[at : upto + 1]), values[ends[at] : ends[upto]]))
                size += upto - at
                at = upto
                if size == most:
                    yield block()
                    size = 0
        if size:
            yield block()

    taken = df.where(F.col(key).isNotNull() & usable(F.col(vector)))
    plain = taken.select(F.col(key).cast("long"), F.transform(vector, lambda x: x.cast("double")).alias(vector))
    return plain.mapInArrow(run, "n int, wide boolean, ids binary, data binary")


def _unpack(row) -> Shard:
    ids = np.frombuffer(row.ids, np.int64)
    if not row.wide:
        return Shard(ids, np.frombuffer(row.data, np.int32).astype(np.int64).reshape(-1, len(ids)))
    data = np.frombuffer(row.data, np.float64).reshape(-1, len(ids))
    small = not data.size or np.abs(data).max() < 2.0**53
    return Shard(ids, (data * SCALE).astype(np.int64) if small else _integers(data))


def top_k(rows: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """query_id, rank, and the key and score of the k best rows of each query."""
    spark = rows.sparkSession
    number = F.monotonically_increasing_id()  # only names settled blocks
    shards = common.settle(_pack(rows, key, vector, SHARD).withColumn("at", number), "shards")
    asked_for = queries.where(F.col(key).isNotNull() & usable(F.col(vector))).groupBy(key).agg(F.min(vector).alias(vector))
    asked_for = common.settle(asked_for, "queries")
    dealt = asked_for.repartition(max(1, -(-asked_for.count() // BLOCK)), key)
    blocks = common.settle(_pack(dealt, key, vector, BLOCK).withColumn("at", number), "query-blocks")

    # names of blocks: a few rows for millions of vectors
    n_blocks, n_shards = blocks.count(), shards.count()
    groups = max(1, -(-n_shards // GROUP), min(n_shards, common.shuffle_partitions(spark) // max(1, n_blocks)))
    names = W.orderBy("at")
    shard_no = shards.select("at", (F.row_number().over(names) % groups).cast("int").alias("g"))
    block_no = blocks.select("at", F.row_number().over(names).cast("int").alias("qb"))
    columns = ["n", "wide", "ids", "data"]
    left = shards.join(shard_no, "at").select("g", F.explode(F.sequence(F.lit(1), F.lit(max(1, n_blocks)))).alias("qb"), *columns)
    right = blocks.join(block_no, "at").select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "qb", *columns)

    def search(shard_rows: pd.DataFrame, block_rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, str, int]] = []
        asked = [(b, i) for b in map(_unpack, block_rows.itertuples()) for i in range(len(b.ids))]
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        for row in shard_rows.itertuples():
            shard = _unpack(row)
            for j, (b, i) in enumerate(asked):
                best[j] = shard.search(b.columns[:, i], int(b.ids[i]), k, best[j])
        for (b, i), found in zip(asked, best, strict=True):
            out += [(int(b.ids[i]), x, *_parts(-s)) for s, x in found]
        return pd.DataFrame(out, columns=["query_id", key, "score", "_sign", "_size", "_digits"])

    found = (
        left.groupBy("g", "qb")
        .cogroup(right.groupBy("g", "qb"))
        .applyInPandas(search, f"query_id long, {key} long, score long, _sign int, _size int, _digits string")
        .where("query_id IS NOT NULL")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("_sign"), F.desc("_size"), F.desc("_digits"), key)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")


def _parts(score: int) -> tuple[int, int, int, str]:
    """The score held within a long, and columns that order larger ones."""
    if -LONG <= score < LONG:
        return score, 0, 0, ""
    sign = 1 if score > 0 else -1
    size = score.bit_length()
    width = -(-size // 4)
    digits = abs(score) if sign > 0 else (1 << 4 * width) - abs(score)
    return max(-LONG, min(LONG - 1, score)), sign, sign * size, f"{digits:0{width}x}"


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for every one whose id 50 divides."""
    rows = common.table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 50 = 0"))


OP4_SQL = """
WITH u AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e FROM u
), a AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e
  FROM u WHERE vec_id % 50 = 0 GROUP BY vec_id
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e, true), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM a q JOIN v c ON q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
