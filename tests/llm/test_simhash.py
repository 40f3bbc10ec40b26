import random

import duckdb
import numpy as np
import pytest
from brute import EDGES, documents, groups, near

from tallyhouse.llm import simhash
from tallyhouse.llm.queries import QUERIES


def test_edges(spark):
    rows = simhash.near_groups(documents(spark)).collect()
    want = near([(i, t) for i, t, _ in EDGES])
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_groups(documents(spark, [])).count() == 0


def test_query_over_documents(spark):
    texts = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows = QUERIES["op7_simhash_groups"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, rows)) == sorted((i, f"{fp:016x}", c) for i, fp, c in near(texts))


def clustered(rng, n, bits=50):
    keys = np.full(n, rng.integers(0, 1 << 62), np.uint64)
    keys[n // 2:] = rng.integers(0, 1 << 62, n - n // 2, dtype=np.uint64)
    for _ in range(5):
        keys ^= np.uint64(1) << rng.integers(0, bits, n).astype(np.uint64)
    return np.unique(keys)


@pytest.mark.parametrize("seed", range(3))
def test_walk_finds_the_components_of_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 64)
    keys = clustered(np.random.default_rng(seed), 400)
    cell = keys >> np.uint64(52)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    labels = simhash.close_components(keys, starts, np.r_[starts[1:], len(keys)], 12, 4)
    numbers = list(range(len(keys)))
    want = groups(numbers, lambda a, b: cell[a] == cell[b] and int(keys[a] ^ keys[b]).bit_count() <= 4)
    assert labels.tolist() == [want[n] for n in numbers]


@pytest.mark.parametrize("slice_rows", [1 << 16, 5])
def test_links_join_all_near_prints_whatever_the_slices(spark, slice_rows, monkeypatch):
    keys = clustered(np.random.default_rng(7), 300).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(k,) for k in keys], "fp long"), slice_rows=slice_rows)
    pairs = [(r["a"], r["b"]) for r in links.collect()]
    assert all((a ^ b) % (1 << 64) and a in keys and b in keys for a, b in pairs)
    joined = groups(keys, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    want = groups(keys, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 4)
    assert joined == want
    assert len(pairs) <= 5 * len(keys)


def test_components_of_paths_stars_and_random_links(spark):
    rng = random.Random(1)
    path = [(n, n + 1) for n in range(0, 40)]
    star = [(100, n) for n in range(101, 140)]
    loose = [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    links = [*path, *star, *loose]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == groups(nodes, lambda a, b: (a, b) in links or (b, a) in links)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(f"w{n * n % 97}" for n in range(500)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 13)
    assert simhash.fingerprint(text) == whole
