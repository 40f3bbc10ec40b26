import random

import duckdb
import numpy as np
from brute import EDGES, contaminated, documents, sha

from tallyhouse.llm import decontam
from tallyhouse.llm.queries import QUERIES

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven"), (2, "Another TEXT"), (3, None), (4, ""), (5, "..."),
    (10, "of a very long text, with 3 and password=abc"), (None, "no id here"), (2, "Another TEXT"), (7, "six seven eight"),
]


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as h", "'y' as doc_id")


def check(spark, rows, items, **options):
    docs = documents(spark, [(i, t, "en") for i, t in rows])
    found = decontam.contamination(docs, table(spark, items), **options).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found]
    assert sorted(got, key=repr) == sorted(contaminated(rows, items), key=repr)
    return got


def test_edges(spark):
    got = check(spark, [(i, t) for i, t, _ in EDGES], ITEMS)
    assert sum(n > 0 for _, _, n, _ in got) >= 5
    check(spark, [(i, t) for i, t, _ in EDGES], [])
    assert decontam.contamination(documents(spark, []), table(spark, ITEMS)).count() == 0


def test_random_texts_of_few_words_even_with_a_full_filter(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices("abc", k=n))
    rows = [(n, text(rng.randint(0, 60))) for n in range(80)]
    items = [(n, text(rng.choice([1, 3, 9, 10, 14, 30]))) for n in range(100, 125)]
    check(spark, rows, [x for x in items if len(x[1]) > 12], filter_bits=64)
    check(spark, rows, items)


def test_winnowing_takes_one_of_every_window():
    grams = np.random.default_rng(2).integers(0, 50, 500).astype(np.uint64)
    places = decontam.winnow(grams, 6)
    assert all(((places >= k) & (places < k + 6)).any() for k in range(495))
    assert len(places) < 250


def test_query_over_documents(spark):
    read = lambda name, key: duckdb.sql(f"select {key}, text from '/root/testdata/sf0.01/{name}.parquet'").fetchall()
    want = contaminated(read("documents", "doc_id"), read("benchmark", "item_id"))
    rows = QUERIES["op8_decontamination"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r["contaminated"] for r in rows) > 10
    assert sorted(map(tuple, rows)) == sorted((i, n, hit, len(x), sha(",".join(x)), hit > 0) for i, n, hit, x in want)
