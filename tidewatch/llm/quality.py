"""Operator 7: quality classifier. Document statistics, random Fourier features
of a Gaussian kernel, ridge regression by partition-summed normal equations,
isotonic calibration.

Statistics are read once from every whole text and settled. The model learns
from every labelled row outside the held-out fold: each partition sums its
outer products by part, Spark adds the sums cell by cell, and only the fixed
number of cells reaches the driver. The parts are the four remainders of ids
outside the fold: calibration takes each row's raw score from the model of the
other three parts, pools adjacent violators over a fixed number of score bins,
and a small share of the raw score keeps the order within its steps.

Null texts count as empty and get a score like any text. Labels that are null,
of another document or of a held-out one teach nothing; several labels of one
document each count. With no usable label every score is 0.5. Repeated rows are
scored each; rows of a null doc_id are scored and never learned from, and their
remainder is that of an empty text, 0, so they count as held out. Statistics of
a very long text take memory in proportion to it. Only doc_id and text are read,
so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import common

FEATURES = 128  # random Fourier features
BANDWIDTH = 3.0  # of the kernel, in standard deviations of the statistics
RIDGE = 1.0
BINS = 2048
CUT = 0.3
_CLASSES = [b"!", b"|", b"$%&#*", b".,;:?", b"0123456789", b"\n", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", bytes(range(128, 256)), b"<>{}[]=/\\@"]
_MASK = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES):
    _MASK[list(_bytes), _k] = 1
N_STATS = 9 + len(_CLASSES)
PARTS = 5  # remainders; the first is held out


def part_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(PARTS)).cast("int")


def statistics(text: str | None) -> np.ndarray:
    """The fixed-length statistics of one text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _MASK / size
    lines = [x for x in raw.split(b"\n") if x]
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    tailed = sum([not w[-1:].isalnum() and w[-1] < 128 for w in words])
    return np.array(
        [
            np.log1p(len(raw)),
            np.log1p(len(words)),
            size / n,
            distinct / n,
            repeats / n,
            (pairs + 1) / n,
            1 - len(set(lines)) / max(1, len(lines)),
            tailed / n,
            np.log1p(n / max(1, len(lines))),
            *np.sqrt(shares),
        ],
        np.float64,
    )


def _key(text: str = "text") -> list[Column]:
    """128 bits that stand for a row's id and text, so that rows are judged each;
    they spread an id that a third of all rows share."""
    return [F.xxhash64("doc_id", text).alias("key_a"), F.xxhash64(F.lit(1), "doc_id", text).alias("key_b")]


def document_statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """doc_id, key_a and key_b (see _key), stats of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(3)
            rows = np.array([statistics(texts[i].as_py()) for i in range(len(texts))], np.float64).reshape(-1, N_STATS)
            ends = np.arange(0, rows.size + 1, N_STATS, dtype=np.int32)
            stats = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], stats], names=["doc_id", "key_a", "key_b", "stats"])

    return docs.select("doc_id", *_key(text), text).mapInArrow(run, f"doc_id {kind}, key_a long, key_b long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    heights: np.ndarray | None = None

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """cos(Wx + b) with rows of W drawn from the kernel's spectrum, and a 1."""
        rng = np.random.default_rng(7)
        w = rng.standard_normal((N_STATS, FEATURES)) / BANDWIDTH
        shift = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.sqrt(2 / FEATURES) * np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ w + shift)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.heights)
        return np.clip(0.99 * level + 0.01 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N_STATS)


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to values in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit(stats: DataFrame, labels: DataFrame, *, label: str = "quality") -> Model:
    """stats: settled document_statistics; labels: doc_id and a 0/1 column."""
    train = stats.drop("key_a", "key_b").join(labels.select("doc_id", F.col(label).cast("double").alias("y")).where("y IS NOT NULL"), "doc_id")
    train = common.settle(train.withColumn("part", part_of(F.col("doc_id"))).where("part <> 0"), "quality-train")
    at = [F.col("stats")[i] for i in range(N_STATS)]
    row = train.agg(
        F.count("*"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]
    ).first()
    if not row[0]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    mean, scale = np.array(row[1 : N_STATS + 1]), np.array(row[N_STATS + 1 :])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))

    size = (FEATURES + 1) * (FEATURES + 2)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, FEATURES + 1, FEATURES + 2))
        for b in batches:
            z = model.fourier(_matrix(b.column("stats")))
            zy, part = np.column_stack([z, b.column("y").to_numpy()]), b.column("part").to_numpy()
            for p in np.unique(part):
                total[p] += z[part == p].T @ zy[part == p]
        yield pa.RecordBatch.from_pydict({"part": np.arange(1, PARTS, dtype=np.int32), "v": pa.array(list(total[1:].reshape(PARTS - 1, size)), pa.list_(pa.float64()))})

    summed = train.select("stats", "y", "part").mapInArrow(sums, "part int, v array<double>")
    cells = summed.select("part", F.posexplode("v").alias("cell", "v")).groupBy("part", "cell").agg(F.sum("v").alias("v"))
    total = np.zeros((PARTS, size))
    for r in cells.collect():  # a fixed number of sums
        total[r["part"], r["cell"]] = r["v"]
    total = total.reshape(PARTS, FEATURES + 1, FEATURES + 2)
    penalty = np.eye(FEATURES + 1) * RIDGE
    penalty[-1, -1] = 1e-6

    def solved(both: np.ndarray) -> np.ndarray:
        return np.linalg.solve(both[:, :-1] + penalty, both[:, -1])

    everything = total.sum(axis=0)
    model.weights = solved(everything)
    others = np.array([solved(everything - total[p]) if p else model.weights for p in range(PARTS)])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BINS, 3))
        for b in batches:
            s = (model.fourier(_matrix(b.column("stats"))) * others[b.column("part").to_numpy()]).sum(axis=1)
            k = np.clip(((s + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)
            for i, v in enumerate((np.ones(len(s)), b.column("y").to_numpy(), s)):
                total[:, i] += np.bincount(k, v, BINS)
        has = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_pydict({"bin": has.astype(np.int32), **{c: total[has, i] for i, c in enumerate("nys")}})

    counted = train.select("stats", "y", "part").mapInArrow(binned, "bin int, n double, y double, s double")
    rows = sorted(counted.groupBy("bin").agg(*[F.sum(c).alias(c) for c in "nys"]).collect())
    n, y, s = (np.array([r[c] for r in rows]) for c in "nys")
    model.knots, model.heights = s / n, pool_adjacent(y / n, n)
    common.release(train)
    return model


def _scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, key_a, key_b, score of every row of docs."""
    stats = common.settle(document_statistics(docs), "quality-stats")
    model = fit(stats, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix(b.column("stats")))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(score)], names=["doc_id", "key_a", "key_b", "score"])

    return stats.mapInArrow(run, f"doc_id {kind}, key_a long, key_b long, score double")


def classify(docs: DataFrame, labels: DataFrame, *, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    return _scored(docs, labels).select(
        "doc_id",
        (part_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, cut: float = CUT) -> DataFrame:
    """The documents that the classifier does not reject. Rows are judged each
    by their own text, those of a null or shared id too."""
    bad = _scored(docs, labels).where(F.col("score") < cut).select("key_a", "key_b").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *_key())
    return whole.join(bad, ["key_a", "key_b"], "left_anti").select("doc.*")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
