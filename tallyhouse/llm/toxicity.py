"""Toxicity by cumulative-link ordinal regression.

Grades 0 < 1 < ... < K are cut from one score by K ordered thresholds: the chance
of a grade above k is the logistic function of score - threshold k. All thresholds
share the weights, one for each word or word beginning of a vocabulary, of which a
document has a feature if it occurs. The expected severity is the sum of the K
chances, from 0 to K.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import written

#: The model is fitted on about so many documents with and without the label, chosen
#: by a hash of their ids. A word is a feature if at least MIN_DOCS of these have it
#: and its share of the documents with the label is APART standard errors or more
#: from its share of the others.
LABEL_DOCS = 3000
MIN_DOCS = 4
APART = 4.0
#: Beginnings of words that are features, by length.
STEMS = (4, 6)
#: What a toxic document that is missed weighs, with a false alarm as 1.
MISSED = 2.0
#: Of the fit: rounds at most, weight of the squared weights, rounds remembered.
ROUNDS = 60
#: Parts of the sample, each summed by a task in every round.
PARTS = 8
PENALTY = 1e-3
MEMORY = 7

_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    """Different words in lower case, and beginnings of longer ones (with a hyphen)."""
    words = set(_WORD.findall((text or "").lower()))
    stems = {word[:size] + "-" for word in words for size in STEMS if len(word) > size}
    return words | stems


@dataclass
class Severity:
    """Weights by feature, and thresholds in order."""

    places: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> float:
        found = [self.places[f] for f in features_of(text) if f in self.places]
        return float(self.weights[sorted(found)].sum())

    def above(self, score: float) -> np.ndarray:
        """Chances of a grade above 0, above 1, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))


def _documents_with(batches):
    """Partial counts of documents, with the label and without, that have a feature."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            for feature in features_of(text):
                counts.setdefault(feature, [0, 0])[label] += 1
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(list(counts), pa.string()),
            "without": pa.array([n[0] for n in counts.values()], pa.int64()),
            "having": pa.array([n[1] for n in counts.values()], pa.int64()),
        })


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", quality: str = "quality", doc_id: str = "doc_id",
    text: str = "text", label_docs: int = LABEL_DOCS,
) -> DataFrame:
    """(label, grade, text): about label_docs documents with the label (1) and without (0).

    Grades come from the labels alone: 0 without the label, 1 with it, 2 with it in a
    document that is labelled as of no quality. Rows of labels without id or label, or
    whose id no document has, do not count, and repeated ones count once; of an id that
    several rows of documents have one text is taken, that of the smallest hash. The
    chosen ids, a bounded number, are broadcast, and their texts alone are shuffled.
    """
    has, bad = F.col(label) > 0, F.coalesce(F.col(quality) == 0, F.lit(False))
    marks = labels.select(
        F.col(doc_id).alias("doc_id"), has.cast("int").alias("label"), (has.cast("int") + (has & bad).cast("int")).alias("grade")
    ).where("doc_id is not null and label is not null").distinct()
    counts = {row["label"]: row["n"] for row in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, min(1.0, label_docs / n)).otherwise(share)
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    of = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "grade").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("of")
    )
    return of.select("label", "grade", "of.text")


def graded(sample: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, list[str]]:
    """(grade, text) of a labelled sample, and the features to fit on: all that are
    APART or further in documents with the label and without."""
    sizes = {row["label"]: row["n"] for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = max(1, sizes.get(0, 0)), max(1, sizes.get(1, 0))
    all_of = (F.col("without") + F.col("having")) / (n0 + n1)
    error = F.sqrt(F.greatest(all_of * (1 - all_of), F.lit(1e-12)) * (1 / n0 + 1 / n1))
    counts = (
        sample.select("label", "text").mapInArrow(_documents_with, "feature string, without long, having long")
        .groupBy("feature").agg(F.sum("without").alias("without"), F.sum("having").alias("having"))
        .where(F.col("without") + F.col("having") >= min_docs)
        .where(F.abs(F.col("having") / n1 - F.col("without") / n0) / error >= APART).select("feature")
    ).collect()
    return sample.select("grade", "text"), sorted(row["feature"] for row in counts)


def _indexed(places: dict[str, int]):
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(
            [sorted(places[f] for f in features_of(text.as_py()) if f in places) for text in texts], pa.list_(pa.int32())
        )

    return run


def _slopes(weights: np.ndarray, thresholds: np.ndarray):
    """Sums over each batch's rows: the negative log-likelihood (place -1), and its
    slope by each weight and each threshold (the places after the weights)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            grade = batch.column("grade").to_numpy()
            share = batch.column("share").to_numpy()
            found = batch.column("found")
            offsets = found.offsets.to_numpy()
            place = found.values.to_numpy()[offsets[0]:offsets[-1]]
            row = np.repeat(np.arange(len(grade)), np.diff(offsets))
            score = np.bincount(row, weights[place], len(grade))
            cuts = np.concatenate([[-np.inf], thresholds, [np.inf]])
            # Chances of at least the grade, and of a higher one.
            at_least, higher = (1 / (1 + np.exp(np.clip(cuts[grade + k] - score, -500, 500))) for k in (0, 1))
            chance = np.maximum(at_least - higher, 1e-12)
            slope = share * (at_least + higher - 1)
            by_weight = np.bincount(place, slope[row], len(weights))
            lower_cut = share * at_least * (1 - at_least) / chance
            upper_cut = share * higher * (1 - higher) / chance
            by_cut = np.bincount(grade, lower_cut, len(cuts))[1:len(cuts) - 1] - np.bincount(grade, upper_cut, len(cuts))[:len(cuts) - 2]
            some = np.flatnonzero(by_weight)
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(np.concatenate([[-1], some, len(weights) + np.arange(len(thresholds))]), pa.int32()),
                "amount": pa.array(np.concatenate([[-(share * np.log(chance)).sum()], by_weight[some], by_cut])),
            })

    return run


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Thresholds in order, from numbers that may be any: the first, then logarithms of steps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def minimum(loss, start: np.ndarray, scale: np.ndarray, rounds: int, flat: float = 1e-3) -> np.ndarray:
    """A minimum by limited-memory BFGS; loss gives the value and the slope at a place.

    scale says how far each parameter should move for its slope, all others alike.
    It ends where no slope is over `flat`, or after so many rounds.
    """
    x, (value, slope) = start, loss(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(slope).max() < flat:
            break
        way, used = slope.copy(), []
        for s, y in reversed(steps):
            used.append((s @ way) / (s @ y))
            way -= used[-1] * y
        way *= scale
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ (scale * y))
        for (s, y), a in zip(steps, reversed(used)):
            way += s * (a - (y @ way) / (s @ y))
        # No parameter moves by more than one at a time.
        size = min(1.0, 1.0 / max(1e-12, np.abs(way).max()))
        for _ in range(6):
            tried = x - size * way
            new_value, new_slope = loss(tried)
            if new_value <= value - 1e-4 * size * (slope @ way):
                break
            size /= 4
        else:
            if not steps:
                return x
            steps = []
            continue
        if (tried - x) @ (new_slope - slope) > 1e-10:
            steps = [*steps, (tried - x, new_slope - slope)][-MEMORY:]
        x, value, slope = tried, new_value, new_slope
    return x


def fit_severity(
    rows: DataFrame, features: list[str], grade: str = "grade", text: str = "text", rounds: int = ROUNDS,
    penalty: float = PENALTY,
) -> Severity:
    """The model, from a bounded sample of rows with a text and a grade 0, 1, ...

    The grades above 0 together weigh MISSED times as much as grade 0. In each round tasks sum slopes over their rows, and
    the driver, which holds one number for each feature, adds these up. Without two
    grades the model finds everything clean.
    """
    found = F.arrow_udf(_indexed({f: k for k, f in enumerate(features)}), "array<int>")
    points = written(
        rows.select(F.col(grade).cast("int").alias("grade"), F.col(text).alias("text")).where("grade >= 0")
        .select("grade", found("text").alias("found")).repartition(PARTS), "severity-points",
    )
    counts = {r["grade"]: r["n"] for r in points.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    top = max(counts, default=0)
    if len(counts) < 2:
        return Severity({}, np.zeros(0), np.array([500.0]))
    graver = sum(n for value, n in counts.items() if value)
    share = F.when(F.col("grade") == 0, 1 / counts.get(0, 1)).otherwise(MISSED / graver) / (1 + MISSED)
    weighted = points.withColumn("share", share)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, free = x[:len(features)], x[len(features):]
        # At most as many rows as parts times parameters.
        sums = weighted.mapInArrow(_slopes(weights, _thresholds(free)), "place int, amount double").toArrow()
        total = np.zeros(len(x) + 1)
        np.add.at(total, sums.column("place").to_numpy(), sums.column("amount").to_numpy())
        slope, value = total[:-1], float(total[-1])
        # Each free number moves its own threshold and all after it.
        from_here = np.cumsum(slope[len(features):][::-1])[::-1]
        slope[len(features):] = from_here * np.concatenate([[1.0], np.exp(free[1:])])
        slope[:len(features)] += penalty * weights
        return value + penalty / 2 * float(weights @ weights), slope

    # A feature's curvature is at most a quarter of the weight of the rows that have it.
    scale = np.full(len(features) + top, 4.0)
    scale[:len(features)] = 1 / penalty
    held = weighted.select("share", F.explode("found").alias("place")).groupBy("place").agg(F.sum("share").alias("s"))
    for row in held.collect():
        scale[row["place"]] = 1 / (row["s"] / 4 + penalty)
    found_at = minimum(loss, np.zeros(len(features) + top), scale, rounds)
    return Severity(
        {f: k for k, f in enumerate(features)}, found_at[:len(features)], _thresholds(found_at[len(features):])
    )


def severity_of(text: Column, model: Severity) -> Column:
    """(severity, grade, toxic): the expected severity, how many thresholds are passed
    with a chance over one half, and whether any is. A null text is read as empty."""

    def run(texts: pa.Array) -> pa.Array:
        above = np.array([model.above(model.score(text.as_py())) for text in texts]).reshape(len(texts), -1)
        grade = (above > 0.5).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(grade > 0)], names=["severity", "grade", "toxic"]
        )

    return F.arrow_udf(run, "severity double, grade int, toxic boolean").asNondeterministic()(text)
