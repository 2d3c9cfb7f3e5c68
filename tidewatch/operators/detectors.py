"""Three anomaly detectors and the equal-budget flag.

Each takes rows with a unique key and numeric feature columns and gives rows
with a score; a higher score is worse.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.selection import nth_row
from tidewatch.operators.storage import settle

EULER = 0.5772156649015329
TREES, SAMPLE, SEED = 300, 4096, 7
NEIGHBORS, DECIMALS = 20, 1
BLOCK, ROWS = 1024, 256  # points of a block; rows of a distance matrix
DENSITY_GUARD = 1e-10


def zscore_score(features: Sequence[str]) -> Column:
    """Largest absolute feature; nulls don't count, none at all gives null."""
    parts = [F.abs(F.col(c)) for c in features]
    return F.greatest(*parts) if len(parts) > 1 else parts[0]


# isolation forest (Liu, Ting and Zhou 2008)


def _path_bonus(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points, to a multiple
    of 2^-20, so that sums of it are exact in any order."""
    n = np.asarray(n, np.float64)
    harmonic = np.log(np.maximum(n - 1, 1)) + EULER
    mean = np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))
    return np.round(mean * (1 << 20)) / (1 << 20)


PRIME = 2**31 - 1


def drawn(x: np.ndarray) -> np.ndarray:
    """A permutation of 0 .. PRIME-1 that any engine's integers can follow: the
    fifth power modulo the prime."""
    x = np.asarray(x, np.int64) % PRIME
    square = x * x % PRIME
    return square * square % PRIME * x % PRIME


def tree_seed(seed: int, tree: int) -> int:
    return int(hashlib.md5(f"{seed}|tree|{tree}".encode()).hexdigest()[:7], 16)


def grow_tree(sample: np.ndarray, draw: int) -> pd.DataFrame:
    """One tree as rows (node, feature, cut, left, depth); a leaf has left -1 and
    its depth includes the bonus for the points it could not part. Nodes are
    numbered as in a heap (1, then 2n and 2n+1); a node's number and the tree's
    draw choose among the features that still differ and the share of their
    range at which to cut. All nodes of a depth are made at once."""
    limit = math.ceil(math.log2(max(2, len(sample))))
    node, x, made = np.ones(len(sample), np.int64), sample, []
    for depth in range(limit + 1):
        if not len(node):
            break
        order = np.argsort(node, kind="stable")
        ids, starts, n = np.unique(node[order], return_index=True, return_counts=True)
        low, high = np.minimum.reduceat(x[order], starts, axis=0), np.maximum.reduceat(x[order], starts, axis=0)
        apart = high > low
        inner = apart.any(axis=1) & (depth < limit)
        y = drawn(draw + ids * 48271)
        pick = y % np.maximum(apart.sum(axis=1), 1)
        feature = np.argmax(np.cumsum(apart, axis=1) == pick[:, None] + 1, axis=1)
        at = np.arange(len(ids))
        a, b = low[at, feature], high[at, feature]
        cut = a + drawn(y + 69621 * ids + 1) / float(PRIME) * (b - a)
        cut = np.where(cut >= b, a, cut)
        made.append(np.column_stack([ids, np.where(inner, feature, -1), np.where(inner, cut, 0.0), np.where(inner, 0.0, depth + _path_bonus(n))]))
        own = np.searchsorted(ids, node)
        on = inner[own]
        right = x[np.arange(len(x)), feature[own]] > cut[own]
        node, x = (2 * node + right)[on], x[on]
    rows = np.concatenate(made)
    rows = rows[np.argsort(rows[:, 0])]
    ids, feature = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64)
    left = np.where(feature >= 0, np.searchsorted(ids, 2 * ids), -1)
    return pd.DataFrame({"node": np.arange(len(ids)), "feature": feature, "cut": rows[:, 2], "left": left, "depth": rows[:, 3]})


def tree_depths(tree: pd.DataFrame, x: np.ndarray) -> np.ndarray:
    feature, cut, left, depth = (tree[c].to_numpy() for c in ("feature", "cut", "left", "depth"))
    node = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(left[node] >= 0)
        if not len(inner):
            return depth[node]
        at = node[inner]
        node[inner] = left[at] + (x[inner, feature[at]] > cut[at])


def isolation_forest_score(
    rows: DataFrame, key: Sequence[str], features: Sequence[str], *, seed: int = SEED, trees: int = TREES, sample: int = SAMPLE, out: str = "iforest_score"
) -> DataFrame:
    """rows with out. Rows are numbered by a hash of seed and key; each tree
    draws its sample from the first numbers by a permutation of its own, and all
    of its choices follow from its draw, so the forest is the same on any engine
    and partitioning. Trees grow in parallel; the forest (at most trees * 2 *
    sample nodes, whatever the input) goes to the executors, which score rows."""
    spark = rows.sparkSession
    features = list(features)
    name = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    place = F.conv(F.substring(name, 1, 7), 16, 10).cast("long")
    # one bounded pool for all trees: enough rows that trees differ
    pool = rows.select(place.alias("_place"), *features).orderBy("_place", *key).limit(sample * 8).toPandas()
    if not len(pool):
        return rows.withColumn(out, F.lit(None).cast("double"))
    psi = min(len(pool), sample)
    shared = spark.sparkContext.broadcast((pool["_place"].to_numpy(np.int64), pool[features].to_numpy(np.float64)))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, held = shared.value
        for b in batches:
            for t in b["id"]:
                draw = tree_seed(seed, int(t))
                pick = np.argsort(drawn(places + draw), kind="stable")[:psi]
                yield grow_tree(held[pick], draw).assign(tree=int(t))

    grown = spark.range(0, trees, 1, min(trees, 32)).mapInPandas(
        grow, "node int, feature int, cut double, left int, depth double, tree int"
    )
    forest = [t.reset_index(drop=True) for _, t in grown.toPandas().sort_values(["tree", "node"]).groupby("tree")]
    sent = spark.sparkContext.broadcast(forest)
    scale = float(_path_bonus(psi)) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64) for c in columns])
        depth = np.zeros(len(x))
        for tree in sent.value:
            depth += tree_depths(tree, x)
        return pd.Series(2.0 ** (-depth / len(sent.value) / scale))

    return rows.withColumn(out, F.round(score(*features), 9))


# local outlier factor (Breunig et al. 2000)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(sum((x[:, j, None] - y[None, :, j]) ** 2 for j in range(x.shape[1]))), 9)


class _Nearest:
    """The k nearest of each row so far; equal distances go by id."""

    def __init__(self, rows: int, k: int):
        self.k, self.reach = k, np.full(rows, np.inf)
        self.row, self.distance, self.other = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, at: int, d: np.ndarray, ids: np.ndarray) -> None:
        cut = self.reach[at : at + len(d)]
        if d.shape[1] > self.k:
            cut = np.minimum(cut, np.partition(d, self.k - 1, axis=1)[:, self.k - 1])
        row, column = np.nonzero((d <= cut[:, None]) & (d < np.inf))
        self.row = np.concatenate([self.row, row + at])
        self.distance = np.concatenate([self.distance, d[row, column]])
        self.other = np.concatenate([self.other, ids[column]])
        row, distance, self.other, place = self.ranked()
        self.row, self.distance = row, distance
        full = place == self.k
        self.reach[row[full]] = distance[full]

    def ranked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((self.other, self.distance, self.row))
        row = self.row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row) + 1
        keep = place <= self.k
        return row[keep], self.distance[order][keep], self.other[order][keep], place[keep].astype(np.int32)


def _search(near: _Nearest, own: np.ndarray, x: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
    for at in range(0, len(x), ROWS):
        d = _distances(x[at : at + ROWS], y)
        d[own[at : at + ROWS, None] == ids[None, :]] = np.inf
        near.add(at, d, ids)


def _blocks(points: DataFrame, width: int, count: int, k: int) -> DataFrame:
    """Distinct points with ids, packed into blocks of points close together (a
    range partition), each with its bounding box and how far its points must
    look at most: the k-th distance within the block, in all and for each."""
    names = [f"x{i}" for i in range(width)]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                part = b.iloc[at : at + BLOCK]
                ids = part["id"].to_numpy(np.int64)
                x = np.ascontiguousarray(part[names].to_numpy(np.float64))
                near = _Nearest(len(x), k)
                _search(near, ids, x, ids, x)
                yield pd.DataFrame(
                    {
                        "ids": [ids.tobytes()], "data": [x.tobytes()], "reach": [near.reach.tobytes()],
                        "low": [x.min(0).tolist()], "high": [x.max(0).tolist()], "most": [float(near.reach.max())],
                    }
                )

    n = max(1, -(-count // BLOCK))
    dealt = points.repartitionByRange(n, *names).sortWithinPartitions(*names)
    return dealt.mapInPandas(pack, "ids binary, data binary, reach binary, low array<double>, high array<double>, most double")


def _meetings(blocks: DataFrame, width: int) -> DataFrame:
    """(b, c): the blocks c that a block b must look into, those whose bounding
    box lies within its reach. A range join on the first axis: boxes are entered
    in the cells they cover, as many cells as blocks, and meet there."""
    first = F.col("low")[0], F.col("high")[0]
    whole = blocks.agg(F.min(first[0]).alias("a"), F.max(first[1]).alias("z"), F.count("*").alias("n")).first()
    n = whole["n"]
    step = (whole["z"] - whole["a"]) / n if n and whole["z"] > whole["a"] else 1.0

    def cells(low: Column, high: Column) -> Column:
        inside = [F.least(F.greatest(F.floor((x - whole["a"]) / step), F.lit(0)), F.lit(n - 1)) for x in (low, high)]
        return F.explode(F.sequence(*inside)).alias("cell")

    margin = F.col("most") + 1e-8
    asking = blocks.select("b", "low", "high", margin.alias("most"), cells(first[0] - margin, first[1] + margin))
    asked = blocks.select(F.col("b").alias("c"), F.col("low").alias("low2"), F.col("high").alias("high2"), cells(*first))
    apart = [F.greatest(F.col("low2")[i] - F.col("high")[i], F.col("low")[i] - F.col("high2")[i], F.lit(0.0)) for i in range(width)]
    near = sum((x * x for x in apart), F.lit(0.0)) <= F.col("most") * F.col("most")
    return asking.join(asked.hint("merge"), "cell").where(near).select("b", "c").distinct()


def nearest_neighbors(points: DataFrame, width: int, k: int) -> DataFrame:
    """(id, other, distance, place) of each point's k nearest others, exact. A
    task compares two blocks at a time and gives what lies within the reach that
    the point's own block already assures. Ties go to the smaller id."""
    packed = _blocks(points, width, points.count(), k)
    blocks = settle(packed.withColumn("b", F.monotonically_increasing_id()), "blocks")
    meetings = _meetings(blocks, width)
    asked = blocks.select("b", "ids", "data", "reach")
    others = blocks.select(F.col("b").alias("c"), F.col("ids").alias("ids2"), F.col("data").alias("data2"))
    pairs = meetings.join(asked, "b").join(others, "c")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in (r for b in batches for r in b.itertuples()):
            own, ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.ids2, np.int64)
            x, y = (np.frombuffer(v).reshape(-1, width) for v in (r.data, r.data2))
            near = _Nearest(len(x), k)
            near.reach = np.frombuffer(r.reach).copy()
            _search(near, own, x, ids, y)
            row, distance, other, _ = near.ranked()
            yield pd.DataFrame({"id": own[row], "other": other, "distance": distance})

    found = pairs.select("ids", "data", "reach", "ids2", "data2").mapInPandas(search, "id long, other long, distance double")
    place = F.row_number().over(W.partitionBy("id").orderBy("distance", "other"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def lof_score(
    rows: DataFrame, features: Sequence[str], *, n_neighbors: int = NEIGHBORS, decimals: int = DECIMALS, out: str = "lof_score"
) -> DataFrame:
    """rows with out: the factor of each row's point after rounding, computed
    once for each distinct point. With one distinct point it is 1."""
    grid = [F.bround(F.col(c).cast("double"), decimals) + F.lit(0.0) for c in features]
    names = [f"x{i}" for i in range(len(features))]
    rounded = rows.withColumns(dict(zip([f"_{n}" for n in names], grid, strict=True)))
    distinct = rounded.select(*[F.col(f"_{n}").alias(n) for n in names]).distinct()
    steps = F.concat_ws(",", *[F.round(F.col(n) * 10**decimals).cast("long").cast("string") for n in names])
    points = settle(distinct.withColumn("id", F.conv(F.substring(F.md5(steps), 1, 15), 16, 10).cast("long")), "distinct")
    k = min(n_neighbors, points.count() - 1)
    if k < 1:
        return rows.withColumn(out, F.lit(1.0))
    near = settle(nearest_neighbors(points, len(names), k), "neighbours")
    reach_of = near.groupBy("id").agg(F.max("distance").alias("k_distance"))
    reach = near.join(reach_of.select(F.col("id").alias("other"), "k_distance"), "other").select(
        "id", "other", F.greatest("distance", "k_distance").alias("reach")
    )
    density = settle(reach.groupBy("id").agg((1 / (F.avg("reach") + DENSITY_GUARD)).alias("density")), "density")
    around = near.join(density.select(F.col("id").alias("other"), F.col("density").alias("theirs")), "other")
    factor = around.groupBy("id").agg(F.avg("theirs").alias("theirs")).join(density, "id")
    ratio = F.round(F.col("theirs") / F.col("density"), 9)
    scored = points.join(factor, "id").select(*[F.col(n).alias(f"_{n}") for n in names], ratio.alias(out))
    return rounded.join(scored, [f"_{n}" for n in names]).select(*rows.columns, out)


# flags


def budget_size(n: Column, rate: float) -> Column:
    """How many rows a rate flags: rounded half to even, one at least."""
    return F.greatest(F.lit(1), F.bround(n * F.lit(rate)).cast("long"))


def flag_top(rows: DataFrame, score: str, key: Sequence[str], *, rate: float | None = None, k: int | None = None, out: str) -> DataFrame:
    """rows with the boolean out: true for exactly the highest k, or the rate's
    share, of scores; ties by key. Only rows at or above an approximate quantile
    just below the cut are put in order, part by part; the last one flagged is
    the boundary that all rows are held against."""
    if (rate is None) == (k is None):
        raise ValueError("give either a rate or k")
    total = rows.select(score).agg(F.count("*").alias("n"), F.count(score).alias("known"))
    size = total.select("n", "known", (F.lit(k).cast("long") if k is not None else budget_size(F.col("n"), rate)).alias("k")).first()
    if not size["known"]:
        return rows.withColumn(out, F.lit(False))
    share = max(0.0, 1 - (size["k"] + 1) / size["known"] - 0.002)
    near = rows.agg(F.percentile_approx(score, share, 10_000).alias("v")).first()["v"]
    order = [F.desc(score), *[F.asc(c) for c in key]]
    above = rows.select(score, *key).where(F.col(score) >= near)
    last = nth_row(above, order, min(size["k"], size["known"]))
    if last is None:
        return rows.withColumn(out, F.lit(False))
    inside = F.col(score) > F.lit(last[score])
    tie = F.col(score) == F.lit(last[score])
    for c in key:
        inside = inside | (tie & (F.col(c) < F.lit(last[c])))
        tie = tie & (F.col(c) == F.lit(last[c]))
    return rows.withColumn(out, F.coalesce(inside | tie, F.lit(False)))
