"""Operator 9: toxicity by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades,
one ordered threshold between neighbours. x counts terms (log1p) of the whole
lower-cased text. The expected severity is the sum over k of P(grade > k).

The model is fitted on a bounded sample of the labelled rows, the SAMPLE pairs
of text and label of smallest hash; every document is scored. Terms enter the
model if their document frequencies show them commoner in toxic rows of the
sample by a likelihood-ratio deviance of DEVIANCE, at most TERMS of them; a term
of fewer than LEAST toxic rows cannot show it.

The labels mark documents toxic or not, so they alone support one threshold.
Grades of toxic documents are drawn from models that have not seen them: the
sample is halved by hash, a binary model of each half scores the toxic rows of
the other, and these scores are cut into GRADES-1 equal shares, the severer the
higher. The ordinal model is then fitted on all grades together.

Null texts count as empty. Null labels and labels of unknown documents teach
nothing. With labels of one class only, or none, every severity is 0. Repeated
rows are scored each; several labels of one document count each. A very long
text takes memory in proportion to it. Only doc_id and text are read, so other
columns may have any name; rows of a null doc_id are scored and never learned
from. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import common

SAMPLE, TERMS, DEVIANCE, LEAST = 30_000, 2_000, 21.0, 3
GRADES = 4
RIDGE, STEPS = 0.03, 1500
CUT = 0.4  # of the probability that the grade is above 0
#: ASCII bytes other than letters and digits part words.
_PART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_PART).split()


@dataclass
class Model:
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))

    def activity(self, text: str | None) -> float:
        words = terms(text)
        held = self.vocabulary.keys() & set(words)
        if not held:
            return 0.0
        n = Counter(w for w in words if w in held)
        return float(sum(np.log1p(n[w]) * self.weights[self.vocabulary[w]] for w in sorted(held)))

    def above(self, activity: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0 .. GRADES-2, by row."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - activity[:, None]))


@dataclass
class Rows:
    """Sparse feature rows: value at (row, term); grade and multiplicity by row."""

    row: np.ndarray
    term: np.ndarray
    value: np.ndarray
    grade: np.ndarray
    times: np.ndarray


def fit_ordinal(data: Rows, n_terms: int, grades: int, *, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the penalised likelihood, by Adam on
    the whole sample. Thresholds are a first value and positive gaps."""
    d, grade, times = n_terms, data.grade, data.times.astype(np.float64)
    n, rows = times.sum(), len(grade)
    free = np.zeros(d + grades - 1)
    shares = [np.clip(times[grade > k].sum() / n, 1e-3, 1 - 1e-3) for k in range(grades - 1)]
    start = np.maximum.accumulate([np.log((1 - s) / s) for s in shares])
    free[d] = start[0]
    free[d + 1 :] = np.log(np.maximum(np.diff(start), 0.1))
    m, v = np.zeros_like(free), np.zeros_like(free)

    def sigmoid(t: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(t, -40, 40)))

    for step in range(1, steps + 1):
        w, gaps = free[:d], np.exp(free[d + 1 :])
        cuts = np.concatenate([[-np.inf], np.cumsum([free[d], *gaps]), [np.inf]])
        s = np.bincount(data.row, data.value * w[data.term], rows)
        low, high = sigmoid(cuts[grade] - s), sigmoid(cuts[grade + 1] - s)
        low, high = np.where(grade == 0, 0.0, low), np.where(grade == grades - 1, 1.0, high)
        p = np.maximum(high - low, 1e-12)
        at_low, at_high = times * low * (1 - low) / p, times * high * (1 - high) / p
        g = np.zeros_like(free)
        g[:d] = np.bincount(data.term, data.value * (at_high - at_low)[data.row], d) / n + RIDGE * w / n
        by_cut = np.array([at_low[grade == k + 1].sum() - at_high[grade == k].sum() for k in range(grades - 1)]) / n
        g[d] = by_cut.sum()
        g[d + 1 :] = [by_cut[k + 1 :].sum() * gaps[k] for k in range(grades - 2)]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.1 * min(1.0, 2 * (steps - step + 1) / steps)
        free -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return free[:d], np.cumsum([free[d], *np.exp(free[d + 1 :])])


def graded(data: Rows, half: np.ndarray, n_terms: int) -> np.ndarray:
    """The grade of each row (data.grade: toxic or not): for toxic ones by the
    score that a binary model of the other half gives, cut into equal shares."""
    toxic = data.grade > 0
    score = np.zeros(len(data.grade))
    for own in (0, 1):
        rows = np.flatnonzero(half != own)
        if not (toxic[rows].any() and (~toxic[rows]).any()):
            continue
        place = np.full(len(half), -1)
        place[rows] = np.arange(len(rows))
        inside = place[data.row] >= 0
        part = Rows(place[data.row[inside]], data.term[inside], data.value[inside], data.grade[rows], data.times[rows])
        weights, _ = fit_ordinal(part, n_terms, 2)
        scores = np.bincount(data.row, data.value * weights[data.term], len(half))
        score[half == own] = np.round(scores[half == own], 9)  # sums in another order tie too
    order = np.argsort(score[toxic], kind="stable")
    before = np.cumsum(data.times[toxic][order]) - data.times[toxic][order]
    values, first = np.unique(score[toxic][order], return_index=True)  # equal scores, equal grades
    share = before[first] / max(1, data.times[toxic].sum())
    grade = np.zeros(len(half), np.int64)
    grade[toxic] = 1 + np.floor(share * (GRADES - 1)).astype(np.int64)[np.searchsorted(values, score[toxic])]
    return grade


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample: int = SAMPLE) -> Model:
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").distinct()
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"))
    chosen = texts.join(known, "doc_id").groupBy("_text", "y").agg(F.min("doc_id").alias("doc_id"))
    chosen = chosen.orderBy(F.xxhash64("_text", "y"), "_text", "y").limit(sample)
    chosen = common.settle(chosen, "toxic-sample")  # at most `sample` rows of three numbers
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_text", F.xxhash64("text"))
    rows = named.join(F.broadcast(chosen), ["doc_id", "_text"]).groupBy("_text", "y").agg(F.first("text").alias("text"))
    rows = common.settle(rows, "toxic-rows")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, y in zip(b.column("text"), b.column("y").to_pylist(), strict=True):
                seen[y].update(set(terms(text.as_py())))
        for y in (0, 1):
            words = list(seen[y])
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(words, pa.binary()),
                    "toxic": pa.array([seen[1][w] for w in words] if y else [0] * len(words), pa.int64()),
                    "other": pa.array([0] * len(words) if y else [seen[0][w] for w in words], pa.int64()),
                }
            )

    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return Model()
    a, both = F.col("toxic"), F.col("toxic") + F.col("other")
    share = totals[1] / (totals[0] + totals[1])
    deviance = 2 * (
        a * F.log(a / (both * share))
        + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") / (both * (1 - share)))).otherwise(0.0)
    )
    picked = (
        rows.mapInArrow(count, "term binary, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") >= LEAST)
        .where(a > both * share)
        .withColumn("deviance", deviance)
        .where(F.col("deviance") >= DEVIANCE)
        .orderBy(F.desc("deviance"), "term")
        .limit(TERMS)
        .collect()
    )
    model = Model({bytes(r["term"]): i for i, r in enumerate(picked)})
    if not picked:
        return Model()
    vocabulary = model.vocabulary

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text"):
                n = Counter(vocabulary[w] for w in terms(text.as_py()) if w in vocabulary)
                out.append(np.array(sorted(n.items()), np.int32).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [b.column("y"), b.column("half"), pa.array(out, pa.list_(pa.int32()))], names=["y", "half", "held"]
            )

    # equal rows are counted, not repeated; there are at most `sample` of them
    halved = rows.select("text", "y", F.pmod("_text", F.lit(2)).cast("int").alias("half"))
    got = halved.mapInArrow(features, "y int, half int, held array<int>").groupBy("y", "half", "held").count().collect()
    got.sort(key=lambda r: (r["y"], r["half"], r["held"]))
    held = [np.array(r["held"], np.int64).reshape(-1, 2) for r in got]
    sizes = np.array([len(h) for h in held])
    flat = np.concatenate(held)
    times = np.array([r["count"] for r in got])
    data = Rows(np.repeat(np.arange(len(got)), sizes), flat[:, 0], np.log1p(flat[:, 1]), np.array([r["y"] for r in got]), times)
    data.grade = graded(data, np.array([r["half"] for r in got]), len(picked))
    model.weights, model.thresholds = fit_ordinal(data, len(picked), GRADES)
    common.release(chosen, rows)
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """doc_id, severity (0 to GRADES-1), grade (the likeliest), toxic (1 if a
    grade above 0 has probability CUT or more) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            above = model.above(np.array([model.activity(texts[i].as_py()) for i in range(len(texts))]))
            whole = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(above.sum(axis=1)),
                    pa.array((whole[:, :-1] - whole[:, 1:]).argmax(axis=1).astype(np.int32)),
                    pa.array((above[:, 0] >= CUT).astype(np.int32)),
                ],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, severity double, grade int, toxic int")


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic. Rows are judged each by their own text,
    those of a null or shared id too, where they lie: nothing is shuffled."""
    model = fit(docs, labels)

    @F.arrow_udf("boolean")
    def civil(texts: pa.Array) -> pa.Array:
        activity = np.array([model.activity(t.as_py()) for t in texts], np.float64)
        return pa.array(model.above(activity)[:, 0] < CUT)

    return docs.where(civil("text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
