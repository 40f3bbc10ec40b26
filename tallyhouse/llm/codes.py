"""Vector codes: a codebook for each part of the vectors, trained by exact nearest
entries, which are found with the help of a few pivots (LAESA).

The distances from each part to fixed pivots are computed once and kept with the
part. In a round the entries' distances to the same pivots are computed, a small
table; by the triangle inequality the greatest difference of two such distances is
no more than the distance between part and entry. Entries are tried in the order of
this bound, and those whose bound is over the best distance so far are never
evaluated. What is evaluated is evaluated in integers, so no result hangs on
rounding or on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 12
SCALE = 1024
#: Components are held to this many bits, so that no sum of squares leaves a long. As
#: a component of a vector it is 131,072.
LARGEST = 1 << 27
#: Entries of the least bounds, which are evaluated first; the others follow, as long as
#: their bound is no more than the best distance so far.
FIRST_TRIED = 6
#: Rows that are worked on at once.
BLOCK = 1024


def usable(vector: Column) -> Column:
    """Whether a vector is there and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """The components as integers, rounded down after scaling."""
    scaled = lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
    return F.transform(vector, lambda x: scaled(x).cast("int"))


def cuts(length: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end; they are equal if its length allows."""
    return [(length * k // PARTS, length * (k + 1) // PARTS) for k in range(PARTS)]


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all others, exact."""
    out = np.zeros((len(points), len(others)), np.int64)
    for k in range(points.shape[1]):
        gap = points[:, k, None].astype(np.int64) - others[None, :, k]
        out += gap * gap
    return out


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` different entries, each the one farthest from those before."""
    if not len(entries):
        return entries
    chosen, nearest = [0], squared(entries, entries[:1])[:, 0]
    while len(chosen) < count and nearest.max(initial=0) > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest_entries(
    points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entries_to_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each point's nearest entry, ties to the lower
    index, and how many distances were evaluated.

    `to_pivots` and `entries_to_pivots` are distances, not squared.
    """
    bound = np.zeros((len(entries), len(points)))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(entries_to_pivots[:, p, None] - to_pivots[None, :, p]), out=bound)
    # Square roots are rounded; what they are off by must not lift a bound.
    bound = np.maximum(bound * (1 - 1e-9) - 1e-6, 0)
    bound *= bound
    # Sums of squares up to 2 ** 53 are whole numbers in floating point too, and quicker there.
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    kind = float if 4 * largest ** 2 * max(1, points.shape[1]) < 1 << 53 else np.int64
    points, entries = points.astype(kind), entries.astype(kind)
    tried = min(FIRST_TRIED, len(entries))
    order = np.argpartition(bound, tried - 1, axis=0)[:tried].T
    gap = points[:, None, :] - entries[order]
    found = (gap * gap).sum(axis=2)
    best = found.min(axis=1)
    index = np.where(found == best[:, None], order, len(entries)).min(axis=1)
    np.put_along_axis(bound, order.T, np.inf, axis=0)
    evaluated = order.size
    for k, entry in enumerate(entries):
        row = np.flatnonzero(bound[k] <= best)
        gap = points[row] - entry
        found, nearest = np.einsum("ij,ij->i", gap, gap), best[row]
        better = (found < nearest) | ((found == nearest) & (k < index[row]))
        row, found = row[better], found[better]
        best[row], index[row] = found, k
        evaluated += len(gap)
    return index, best.astype(np.int64), evaluated


@dataclass(frozen=True)
class Codebooks:
    """What a task needs to assign parts: for each part the entries, the pivots, and
    the distances between them."""

    length: int
    entries: list[np.ndarray]
    pivots: list[np.ndarray]

    def assign(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Entry of each part of each vector, the vectors' errors, and how many distances
        were evaluated."""
        codes = np.zeros((len(vectors), PARTS), np.int64)
        errors, evaluated, at = np.zeros(len(vectors), np.int64), 0, 0
        for k, (begin, end) in enumerate(cuts(self.length)):
            entries, pivots = self.entries[k], self.pivots[k]
            codes[:, k], error, n = nearest_entries(
                vectors[:, begin:end], to_pivots[:, at:at + len(pivots)], entries, np.sqrt(squared(entries, pivots))
            )
            errors, evaluated, at = errors + error, evaluated + n, at + len(pivots)
        return codes, errors, evaluated

    def pivot_distances(self, vectors: np.ndarray) -> np.ndarray:
        return np.hstack([
            np.sqrt(squared(vectors[:, begin:end], pivots)) for (begin, end), pivots in zip(cuts(self.length), self.pivots, strict=True)
        ])

    def replaced(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """The entries as means, rounded down, of (part, entry) -> (count, sums)."""
        entries = [old.copy() for old in self.entries]
        for (part, entry), (count, total) in sums.items():
            entries[part][entry] = [x // count for x in total]
        return Codebooks(self.length, entries, self.pivots)

    def text(self) -> str:
        """All components by part, entry and place, joined by commas."""
        return ",".join(str(x) for entries in self.entries for x in entries.ravel().tolist())


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def first_codebooks(points: DataFrame, length: int, pivots: int = PIVOTS) -> Codebooks:
    """Entries from the ENTRIES smallest ids; a repeated id gives its least vector.
    Rows without id give none."""
    ids = points.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()
    rows = points.where(F.col("vec_id").isin([row.vec_id for row in ids])).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    first = sorted(rows.collect(), key=lambda row: row.vec_id)
    start = np.array([row.ints for row in first], np.int64).reshape(len(first), length)
    entries = [start[:, begin:end] for begin, end in cuts(length)]
    return Codebooks(length, entries, [far_apart(part, pivots) for part in entries])


def trained(points: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after so many rounds over all points.

    A task adds up the parts of each entry, so the driver gets one row for each part
    and entry, whatever the number of points.
    """
    widest = max(end - begin for begin, end in cuts(books.length))
    sums = [f"s{k}" for k in range(widest)]
    schema = ", ".join(["part int", "entry int", "n long", *[f"{name} long" for name in sums]])
    for _ in range(rounds):
        if not len(books.entries[0]):
            break

        def added(batches: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            count = np.zeros((PARTS, len(books.entries[0])), np.int64)
            total = np.zeros((*count.shape, widest), np.int64)
            for batch in _blocks(batches):
                vectors = _matrix(batch.column(0), books.length, np.int64)
                codes, _, _ = books.assign(vectors, _matrix(batch.column(1), sum(map(len, books.pivots)), float))
                for k, (begin, end) in enumerate(cuts(books.length)):
                    np.add.at(count[k], codes[:, k], 1)
                    np.add.at(total[k, :, :end - begin], codes[:, k], vectors[:, begin:end])
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
                 *[pa.array(total[part, entry, k], pa.int64()) for k in range(widest)]], ["part", "entry", "n", *sums],
            )

        found = points.select("ints", "to_pivots").mapInArrow(added, schema)
        # Sums of sums leave a long sooner than a part's own do.
        wide = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("n", *sums)]
        rows = found.groupBy("part", "entry").agg(*wide).collect()
        bounds = cuts(books.length)
        books = books.replaced({
            (r.part, r.entry): (int(r.n), [int(r[f"s{k}"]) for k in range(bounds[r.part][1] - bounds[r.part][0])]) for r in rows
        })
    return books


def encoded(points: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error, evaluated) of each point; code has two hex digits a
    part, evaluated is how many exact distances it took."""
    kinds = [f"{name} {points.schema[name].dataType.simpleString()}" for name in ("vec_id", "label")]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            vectors = _matrix(batch.column(2), books.length, np.int64)
            if len(books.entries[0]):
                codes, errors, evaluated = books.assign(vectors, _matrix(batch.column(3), sum(map(len, books.pivots)), float))
                text = [bytes(row).hex() for row in codes.astype(np.uint8)]
            else:
                errors, evaluated, text = [None] * len(vectors), 0, [None] * len(vectors)
            share = np.full(len(vectors), evaluated / max(1, len(vectors)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(errors, pa.int64()), pa.array(share)],
                ["vec_id", "label", "code", "error", "evaluated"],
            )

    return points.select("vec_id", "label", "ints", "to_pivots").mapInArrow(
        assigned, ", ".join([*kinds, "code string", "error long", "evaluated double"])
    )


def vector_codes(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    rounds: int = ROUNDS, pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks]:
    """((vec_id, label, code, error, evaluated) of each vector, the codebooks).

    Vectors that are null or hold a null or non-finite component go, as do those of
    another length than the vector of the smallest id has (of any, if all ids are null).
    Components beyond LARGEST / SCALE count as that. A length that PARTS does not divide
    gives parts that differ by one; empty vectors get the code 00000000 and no error.
    Rows without id are coded and counted, but give no first entry; where no row has
    an id there are no entries, and code and error are null. Repeated rows count each.
    """
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(
        usable(F.col("vector"))
    )
    first = kept.select(F.min(F.struct(F.col("vec_id").isNull(), "vec_id", F.size("vector").alias("n"))).alias("of")).first()
    length = first.of.n if first and first.of else 0
    ints = written(kept.where(F.size("vector") == length).select("vec_id", "label", whole_numbers(F.col("vector")).alias("ints")), "vectors")
    books = first_codebooks(ints, length, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            away = books.pivot_distances(_matrix(batch.column(2), length, np.int64))
            offsets = pa.array(np.arange(len(away) + 1, dtype=np.int32) * away.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(away.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "label", "ints", "to_pivots"])

    kinds = [f"{name} {ints.schema[name].dataType.simpleString()}" for name in ("vec_id", "label")]
    points = written(ints.mapInArrow(measured, ", ".join([*kinds, "ints array<int>", "to_pivots array<double>"])), "pivot-distances")
    books = trained(points, books, rounds)
    return encoded(points, books), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add label_error, the errors of all rows with an equal label, added up; null labels
    are equal. The sums are made before any row moves, so a label may hold most rows."""
    rows = written(coded, "vector-codes")
    sums = written(rows.groupBy(F.col("label").alias("summed_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("summed_label")), "left").drop("summed_label")
