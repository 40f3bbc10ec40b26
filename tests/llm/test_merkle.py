import random

import pytest
import xxhash
from brute import EDGES, documents
from pyspark.sql import functions as F

from tallyhouse.llm import merkle


def following(rows):
    """Each row's next one, as the docstring of with_next says."""
    version = lambda text: xxhash.xxh64_intdigest(text.encode(), 42)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(((i, text or "") for i, text in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -signed(version(r[1]))))
    return [(*row, order[(k + 1) % len(order)][1]) for k, row in enumerate(order)]


@pytest.mark.parametrize("lot", [1, 3, 1000])
@pytest.mark.parametrize("ids", [range(40), [n ** 3 - 900 for n in range(40)], [5] * 10 + [None] * 12 + [-(2 ** 62), 2 ** 62]])
def test_next_document(spark, lot, ids, monkeypatch):
    monkeypatch.setattr(merkle, "LOT", lot)
    rng = random.Random(lot)
    rows = [(i, f"text {rng.randint(0, 4 if lot == 3 else 30)}") for i in ids]
    got = merkle.with_next(documents(spark, [(i, t, "en") for i, t in rows])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(following(rows), key=repr)


def test_ids_of_text(spark):
    rows = [(i, f"text of {i}") for i in ["b", "a", "", "ab", "10", "9", "é", "a"]] + [(None, "none"), ("a", "more")]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    signed = lambda text: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(text.encode(), 42))
    order = sorted(rows, key=lambda r: signed(r[1]), reverse=True)
    order.sort(key=lambda r: (r[0] is not None, (r[0] or "").encode()), reverse=True)
    want = [(*row, order[(k + 1) % len(order)][1]) for k, row in enumerate(order)]
    assert sorted(map(tuple, merkle.with_next(table).collect()), key=repr) == sorted(want, key=repr)


def test_one_far_id_does_not_gather_the_others(spark):
    """Ranges are of equal size, whatever the ids are; so are those of one repeated id."""
    for first in (F.lit(0), F.col("id")):
        docs = spark.range(20_000).select(first.alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
        docs = docs.union(spark.createDataFrame([(10 ** 15, "far")], "doc_id long, text string"))
        keys = docs.select("doc_id", F.xxhash64("text").alias("version"), F.lit(1).cast("long").alias("n")).withColumn(
            "key", merkle._text_key(F.col("doc_id"), F.col("version"))
        )
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sizes = [r["count"] for r in keys.repartitionByRange(F.desc_nulls_last("doc_id"), F.desc("version")).groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 8 and max(sizes) < 5000
            found = merkle._in_order(keys)
            assert found.count() == found.select("next_key").distinct().count() == 20_001
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_both_joins_share_one_exchange_of_the_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = merkle.with_next(documents(spark))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan


def test_edges(spark):
    rows = [(i, t) for i, t, _ in EDGES]
    docs = merkle.with_next(documents(spark))
    assert sorted(map(tuple, docs.collect()), key=repr) == sorted(following(rows), key=repr)
    printed = docs.select("text", merkle.printed(merkle.leaves(F.col("text"))).alias("p")).distinct().collect()
    assert len({r["p"] for r in printed}) == len({r["text"] for r in printed}) == len(printed)
    assert merkle.with_next(documents(spark, [])).count() == 0
    one = merkle.with_next(documents(spark, [(3, "abc", "en")])).collect()
    assert [tuple(r) for r in one] == [(3, "abc", "abc")]


def test_pieces_are_the_whole_text_so_roots_tell_texts_apart(spark):
    texts = ["a", "a\n", "a\n\n", "a\n\nb", "a\nb", "a. b", "a.b", "a. \nb", "", "\n", "\n\n", "a\n\n\nb", " a. b", "a.  b"]
    rows = documents(spark, [(n, t, "en") for n, t in enumerate(texts)])
    roots = rows.select(merkle.root(merkle.leaves(F.col("text"))).alias("r")).collect()
    assert len({r["r"] for r in roots}) == len(texts)


def test_nodes_and_edits_lead_to_the_change(spark):
    one = "First. Second one.\nThird.\n\nNew section. It ends.\n"
    other = "First. Second two.\nThird.\n\nNew section. It ends.\nMore."
    rows = documents(spark, [(1, one, "en"), (2, other, "en"), (3, None, "en")])
    nodes = merkle.merkle_nodes(rows).collect()
    count = lambda doc: sum(n["doc_id"] == doc for n in nodes)
    assert (count(1), count(2), count(3)) == (13, 15, 4)
    digests = {(n["doc_id"], n["section"], n["paragraph"], n["run"]): n["digest"] for n in nodes}
    assert digests[1, 0, 0, 0] == digests[2, 0, 0, 0] and digests[1, 0, 1, None] == digests[2, 0, 1, None]
    assert digests[1, 0, 0, None] != digests[2, 0, 0, None] and digests[1, None, None, None] != digests[2, None, None, None]
    pair = spark.createDataFrame([(one, other), (one, one), ("", "x")], "a string, b string").select(
        merkle.leaves(F.col("a")).alias("a"), merkle.leaves(F.col("b")).alias("b")
    )
    found = pair.select(merkle.edits(F.col("a"), F.col("b")).alias("e"), merkle.likeness(F.col("a"), F.col("b")).alias("n")).collect()
    assert [[tuple(place) for place in row["e"]] for row in found] == [[(0, 0, 1), (1, 1, None)], [], [(0, 0, 0)]]
    assert [round(row["n"], 3) for row in found] == [0.769, 1, 0]


def test_edited_text(spark):
    pairs = [("abcdef", "XY"), ("abcdef", "XYZ"), ("ab", "XYZ"), ("", "X"), ("éß日本語😀", "日X")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(merkle.edited(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == ["abcdXY", "abcdXY", "ab", "", "éß日本日X"]
