import random

import duckdb
import numpy as np
import pytest
from brute import EDGES, documents
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tallyhouse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def made(spark):
    """Grade by the number of bad words: 0, 1 or 3 among plain ones."""
    rng = random.Random(8)
    plain = [f"word{chr(97 + a)}{chr(97 + b)}" for a in range(10) for b in range(10)]
    rows = []
    for n in range(600):
        grade = n % 3
        text = rng.choices(plain, k=20) + rng.sample(["vile", "scum", "trash", "moron", "idiot"], (0, 1, 3)[grade])
        rng.shuffle(text)
        rows.append((grade, " ".join(text)))
    frame = spark.createDataFrame(rows, "grade int, text string")
    features = sorted({f for _, t in rows for f in toxicity.features_of(t)})
    return rows, toxicity.fit_severity(frame, features)


def test_grades_come_in_order_and_share_weights(made):
    rows, model = made
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 2
    severity = {g: np.mean([model.above(model.score(t)).sum() for k, t in rows if k == g]) for g in range(3)}
    assert severity[0] < 0.4 < severity[1] < 1.6 < severity[2] <= 2
    right = sum((model.above(model.score(t)) > 0.5).sum() == g for g, t in rows)
    assert right > 0.95 * len(rows)
    assert model.weights[model.places["scum"]] > 5 * abs(model.weights[model.places["wordaa"]])


def test_slopes_are_those_of_the_loss(spark):
    """Against differences, on three grades."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    batch = pa.RecordBatch.from_pydict({
        "grade": pa.array(rng.integers(0, 3, 40), pa.int32()), "share": pa.array(rng.random(40)),
        "found": pa.array([sorted(rng.choice(6, rng.integers(0, 5), replace=False).tolist()) for _ in range(40)], pa.list_(pa.int32())),
    })

    def loss(x):
        total = np.zeros(9)
        for part in toxicity._slopes(x[:6], x[6:])([batch]):
            np.add.at(total, part.column("place").to_numpy(), part.column("amount").to_numpy())
        return total[-1], total[:-1]

    x = np.concatenate([rng.normal(size=6), [-0.5, 1.0]])
    slope = loss(x)[1]
    for k in range(8):
        step = np.eye(8)[k] * 1e-6
        assert abs((loss(x + step)[0] - loss(x - step)[0]) / 2e-6 - slope[k]) < 1e-5


def test_edges(spark, made):
    rows = documents(spark).withColumn("of", toxicity.severity_of(F.col("text"), made[1])).select("of.*").collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= r["severity"] <= 2 and r["toxic"] == (r["grade"] > 0) for r in rows)
    assert documents(spark, []).select(toxicity.severity_of(F.col("text"), made[1])).count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def test_without_labels_everything_is_clean(spark):
    docs = documents(spark)
    for rows in ([], [(8, 1, 0), (9, 1, 0), (None, 1, 1), (6, 1, None), (99, 1, 1)]):
        model = toxicity.fit_severity(*toxicity.graded(toxicity.labelled_sample(docs, labels(spark, rows))))
        assert not any(r["toxic"] for r in docs.select(toxicity.severity_of(F.col("text"), model).alias("of")).select("of.*").collect())


def test_repeated_labels_count_once(spark):
    sample = toxicity.labelled_sample(documents(spark), labels(spark, [(8, 1, 0)] * 3 + [(6, 0, 1)] * 2 + [(10, 1, 1), (11, None, 1)]))
    assert sorted((r["label"], r["grade"]) for r in sample.collect()) == [(0, 0), (1, 1), (1, 1), (1, 2)]


def test_the_sample_is_bounded_whatever_the_rows_of_an_id(spark):
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 500).alias("text"))
    docs = docs.union(spark.range(400).select(F.col("id") + 100, F.concat(F.lit("other "), "id")))
    rows = [(7, 1, 1)] + [(n + 100, 1, n % 2) for n in range(400)]
    sample = toxicity.labelled_sample(docs, labels(spark, rows), label_docs=50).groupBy("label").count().collect()
    assert {r["label"]: 25 <= r["count"] <= 90 for r in sample} == {0: True, 1: True}


def test_no_feature_that_tells_is_left_out(spark):
    """25,000 words, each in a fifth of the documents with the label and in no other."""
    spell = lambda n: "".join(chr(97 + n // 26 ** k % 26) for k in range(4))
    texts = [" ".join(f"x{spell(5000 * n + k)}" for k in range(5000)) for n in range(5)]
    rows = [(1, 1, text) for text in texts for _ in range(20)] + [(0, 0, f"good {n}") for n in range(100)]
    found = toxicity.graded(spark.createDataFrame(rows, "label int, grade int, text string"))[1]
    assert {f"x{spell(n)}" for n in range(25_000)} <= set(found)


def test_held_out_documents(spark):
    """Fitted on half of the labels, judged on the other half; some labels of these
    tables do not go with their texts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    sample = toxicity.labelled_sample(docs, known.where(half == 0))
    model = toxicity.fit_severity(*toxicity.graded(sample))
    scored = docs.join(known.where(half == 1), "doc_id").select("toxic", toxicity.severity_of(F.col("text"), model).alias("of"))
    rows = scored.select(F.col("toxic").alias("label"), "of.toxic").collect()
    positive = [r["toxic"] for r in rows if r["label"]]
    negative = [r["toxic"] for r in rows if not r["label"]]
    assert len(positive) > 100
    assert sum(positive) >= 0.9 * len(positive)
    assert sum(negative) <= 0.05 * len(negative)


def test_query_grades_labelled_documents(spark):
    truth = dict(duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    wrong = [r["doc_id"] for r in rows if r["doc_id"] in truth and r["toxic"] != bool(truth[r["doc_id"]])]
    assert len(wrong) <= 0.05 * len(truth)
