"""Vector codes against plain loops over all entries."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import codes
from tallyhouse.llm.codes import vector_codes, with_label_error
from tallyhouse.llm.queries import op12_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, ints string, to_pivots string, vector string"
CLASH = ("c", "i", "p", "v")


def brute(rows, entries=256, rounds=4):
    """[(id, vector, label)] -> ({(id, code, error, label_error): rows}, digest of the codebooks)."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return [], None
    length = len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))[1])
    kept = [row for row in kept if len(row[1]) == length]
    first = {}
    for i, v, _ in kept:
        if i is not None:
            first[i] = min(v, first.get(i, v))
    starts = [first[i] for i in sorted(first)[:entries]]
    total, parts, books = [0] * len(kept), [], []
    for k in range(4):
        begin, end = length * k // 4, length * (k + 1) // 4
        book, points = [s[begin:end] for s in starts], [v[begin:end] for _, v, _ in kept]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(book))

        for _ in range(rounds):
            members = defaultdict(list)
            for x in points:
                members[nearest(x, book)[1]].append(x)
            for n, xs in members.items():
                book[n] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
        found = [nearest(x, book) for x in points]
        parts.append([n for _, n in found])
        total = [t + d for t, (d, _) in zip(total, found, strict=True)]
        books.append(book)
    sums = defaultdict(int)
    for (_, _, label), error in zip(kept, total, strict=True):
        sums[label] += error
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(
        ((i, "".join(f"{p[n]:02x}" for p in parts), total[n], sums[label]) for n, (i, _, label) in enumerate(kept)), key=repr
    ), hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows):
    table = spark.createDataFrame([(*row, *CLASH) for row in rows], SCHEMA)
    found, books = vector_codes(table)
    out = with_label_error(found).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, out), key=repr), hashlib.sha256(books.text().encode()).hexdigest()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=8).tolist(), int(i) % 3) for i in rng.permutation(300)]
    rows += [(i, rows[7][1], None) for i in (400, 400, 401, None)] + [(-1, [0.0] * 8, None), (0, rows[3][1], 1)]
    rows += [(500, None, 1), (501, [nan] * 8, 1), (502, [inf] + [0.0] * 7, 1), (503, [None] + [0.0] * 7, 1), (504, [1.0], 2), (505, [], 2)]
    rows += [(600 + n, [-0.5 / 1024] * 8, 9) for n in range(40)]
    assert coded(spark, rows) == brute(rows)


@pytest.mark.parametrize("length", [0, 3, 7])
def test_lengths(spark, length):
    rows = [(n, [float(n % 5 + k) for k in range(length)], n % 2) for n in range(30)]
    assert coded(spark, rows) == brute(rows)


def test_none_and_no_ids(spark):
    assert coded(spark, [])[0] == []
    assert coded(spark, [(None, [1.0, 2.0, 3.0, 4.0], 1)])[0] == [(None, None, None, None)]


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()
    want, digest = brute([(r["vec_id"], r["embedding"], r["label"]) for r in table])
    rows = op12_vector_codes(spark, sf_dir).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=repr) == want
    assert {r.codebooks_sha256 for r in rows} == {digest}
    # The bound spares evaluations: there are 256 entries for each of four parts.
    assert sum(r.evaluated for r in rows) < 0.8 * len(rows) * 4 * codes.ENTRIES


def test_bound_prunes_where_parts_lie_in_clusters():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (256, 16))
    points = centres[rng.integers(0, 256, 3000)] + rng.integers(-40, 40, (3000, 16))
    pivots = codes.far_apart(centres, codes.PIVOTS)
    index, best, evaluated = codes.nearest_entries(
        points, np.sqrt(codes.squared(points, pivots)), centres, np.sqrt(codes.squared(centres, pivots))
    )
    every = codes.squared(points, centres)
    assert (best == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()
    assert evaluated < 0.05 * every.size


def test_hot_label(spark):
    rows = [(n, [float(n % 7), 1.0, 2.0, float(n % 3)], None if n % 3 else n % 4) for n in range(900)]
    assert coded(spark, rows) == brute(rows)
