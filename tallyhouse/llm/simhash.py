"""SimHash near-dedup by a binary trie self-join.

Texts with one fingerprint are one leaf of a binary trie. The self-join walks
pairs of its nodes together, adds a differing bit whenever it takes two different
branches, and leaves a pair as soon as it has more of them than allowed.

To share the walk out among tasks, fingerprints that differ in at most n bits
agree in one of n + 1 blocks of bits. For each block the fingerprint is turned so
that the block comes first, and nodes that agree in it, a cell, are joined in one
task; a cell with too many leaves is cut into slices, and each two slices are
joined. A task returns its leaves' components, so a group of n near copies gives
n rows and not n * n.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import as_bytes, identified, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Shingles whose hashes are held at a time.
BLOCK = 1 << 20
#: Leaves of a slice of a cell; leaves joined at a time; node pairs at a time.
SLICE = 1 << 16
LEAVES = 1 << 17
PAIRS = 1 << 18
#: Node pairs of so few leaf pairs are compared leaf by leaf.
FEW = 16

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = np.arange(8, dtype=np.uint16) * 256


def _votes(hashes: list[int]) -> np.ndarray:
    """For each bit, from the lowest, how many of the hashes have it."""
    lanes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8) + _LANES
    return (np.bincount(lanes.ravel(), minlength=8 * 256).reshape(8, 256) @ _BYTE_BITS).ravel()


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, unsigned; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        votes += _votes([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])])
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long.

    A-Z count as lower case, words are runs without ASCII white space, and each of
    the shingles counts, repeats too. Fewer words than a shingle has are one. A
    null or empty text has fingerprint 0.
    """

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(text, shingle) for text in texts.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return fingerprints.asNondeterministic()(as_bytes(text))


def blocks_of(max_bits: int) -> list[tuple[int, int]]:
    """(bits before, width) of max_bits + 1 blocks of a fingerprint."""
    edges = [BITS * k // (max_bits + 1) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _turned(value: Column, by: int) -> Column:
    """The 64 bits, turned to the left."""
    return value if by == 0 else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining leaves a with leaves b: the smallest of each component."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


def close_components(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, first_bit: int, max_bits: int) -> np.ndarray:
    """A label for each leaf, the same for leaves of a cell that links join.

    Cells are ranges of keys, sorted in each, whose first bits agree. The walk is
    made for one differing bit, then two, and so on: node pairs whose leaves are
    all in one component by then are left out, as no link in them can change that,
    which keeps a crowd of near copies from being compared each with each.
    """
    labels = np.arange(len(keys))
    ones: dict[int, np.ndarray] = {}
    runs = labels.copy()
    for budget in range(1, max_bits + 1):
        zero = np.zeros(len(starts), np.int64)
        stack = [(first_bit, starts, ends, starts, ends, zero)]
        while stack:
            bit, a, a_end, b, b_end, differ = stack.pop()
            apart = (runs[a] != runs[a_end - 1]) | (runs[b] != runs[b_end - 1]) | (labels[a] != labels[b])
            a, a_end, b, b_end, differ = a[apart], a_end[apart], b[apart], b_end[apart], differ[apart]
            few = (a_end - a) * (b_end - b) <= FEW
            if few.any():
                left, right = _leaf_pairs(a[few], a_end[few], b[few], b_end[few])
                near = np.bitwise_count(keys[left] ^ keys[right]) <= budget
                if near.any():
                    labels = _joined(labels, left[near], right[near])
                    runs = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
                many = ~few
                a, a_end, b, b_end, differ = a[many], a_end[many], b[many], b_end[many], differ[many]
            if not len(a):
                continue
            if bit not in ones:
                set_here = (keys >> np.uint64(BITS - 1 - bit)) & np.uint64(1)
                ones[bit] = np.concatenate([[0], np.cumsum(set_here.astype(np.int32))])
            count = ones[bit]
            a_mid = a_end - (count[a_end] - count[a])
            b_mid = b_end - (count[b_end] - count[b])
            other = a != b
            more = differ + 1
            pairs = [np.concatenate(part) for part in zip(
                (a, a_mid, b, b_mid, differ),
                (a_mid, a_end, b_mid, b_end, differ),
                (a, a_mid, b_mid, b_end, more),
                (a_mid[other], a_end[other], b[other], b_mid[other], more[other]),
            )]
            full = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)
            pairs = [part[full] for part in pairs]
            for at in range(0, len(pairs[0]), PAIRS):
                stack.append((bit + 1, *[part[at:at + PAIRS] for part in pairs]))
    return labels


def _leaf_pairs(a, a_end, b, b_end):
    """All pairs of a leaf under a and one under b; each pair once if a is b."""
    wide = b_end - b
    many = (a_end - a) * wide
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    left = np.repeat(a, many) + at // np.repeat(wide, many)
    right = np.repeat(b, many) + at % np.repeat(wide, many)
    once = np.repeat(a != b, many) | (left < right)
    return left[once], right[once]


def _cell_links(first_bit: int, max_bits: int):
    """Rows (block, key, new), sorted, new at the first of a cell, as links (block, key, root)."""

    def links(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def walk(rows: pa.Table):
            keys = rows.column("key").to_numpy().view(np.uint64)
            starts = np.flatnonzero(_changes(rows))
            ends = np.append(starts[1:], len(keys))
            several = ends - starts > 1
            labels = close_components(keys, starts[several], ends[several], first_bit, max_bits)
            moved = np.flatnonzero(labels != np.arange(len(keys)))
            yield pa.RecordBatch.from_pydict({
                "block": rows.column("block").combine_chunks().take(pa.array(moved)),
                "key": pa.array(keys[moved].view(np.int64)),
                "root": pa.array(keys[labels[moved]].view(np.int64)),
            })

        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size < LEAVES:
                continue
            rows = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(_changes(rows))[-1])
            if cut:
                yield from walk(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
            size = rows.num_rows - cut
        if size:
            yield from walk(pa.Table.from_batches(held))

    return links


def _changes(rows: pa.Table) -> np.ndarray:
    """Whether a row begins a cell."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("block", "cell", "low", "high"):
        column = rows.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return new


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, slice_rows: int = SLICE) -> DataFrame:
    """Links (a, b) between different fingerprints of column fp, each there once,
    that join all that differ in at most max_bits bits, directly or by others."""
    blocks = blocks_of(max_bits)
    first_bit = min(width for _, width in blocks)
    keyed = prints.select(F.explode(F.array(*[
        F.struct(
            F.lit(k).alias("block"), _turned(F.col("fp"), before).alias("key"),
            F.shiftrightunsigned(_turned(F.col("fp"), before), BITS - width).alias("cell"),
        ) for k, (before, width) in enumerate(blocks)
    ])).alias("at")).select("at.*")
    crowded = (
        keyed.groupBy("block", "cell").agg(F.count("*").alias("n")).where(F.col("n") > slice_rows)
        .select("block", "cell", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    )
    sliced = keyed.join(crowded, ["block", "cell"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("key"), F.col("slices")).cast("int")
    dealt = (
        sliced.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select(
            "block", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key"
        )
    )
    order = ["block", "cell", "low", "high"]
    found = dealt.repartition(*order).sortWithinPartitions(*order, "key").mapInArrow(
        _cell_links(first_bit, max_bits), "block int, key long, root long"
    )
    back = lambda name: F.coalesce(*[
        F.when(F.col("block") == k, _turned(F.col(name), (BITS - before) % BITS)) for k, (before, _) in enumerate(blocks)
    ])
    return found.select(back("key").alias("a"), back("root").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): the smallest node of its component.

    In rounds: each node takes its smallest neighbour, pointers are followed to
    their ends, and links are drawn between these ends. At least half of the nodes
    go in a round. Tables of each round are written, so a round reads no long plan.
    """
    links = written(links.where("a <> b"), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    roots = written(nodes.select("node", F.col("node").alias("root")), "roots")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "pointers")
        while True:
            above = up.select(F.col("a").alias("up"), F.col("up").alias("top"))
            if up.join(above, "up").where("top <> up").isEmpty():
                break
            up = written(up.join(above, "up").select("a", F.col("top").alias("up")), "pointers")
        moved = up.select(F.col("a").alias("root"), "up")
        roots = written(
            roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots"
        )
        to = up.select(F.col("a").alias("b"), F.col("up").alias("up_b"))
        links = written(
            links.join(up, "a").join(to, "b").select(F.col("up").alias("a"), F.col("up_b").alias("b"))
            .where("a <> b").distinct(), "links",
        )
    return roots


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, version, fp, root, component_id), a row for each document.

    version is a hash of the text, as in common.identified; fp is the fingerprint as a long. Fingerprints that differ in at most max_bits
    bits are linked; component_id is the smallest doc_id that links reach, the
    document's own included. Texts without words are linked like any others. Rows
    without doc_id belong to groups but name none: a group of nothing else has a
    null component_id. root is the group's smallest fingerprint, which names it in any
    case. Repeated rows stay.
    """
    rows = written(identified(docs, doc_id, text).select("doc_id", "version", simhash(F.col("text"), shingle).alias("fp")), "prints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different-prints")
    roots = components(near_links(prints, max_bits))
    linked = prints.join(roots, prints["fp"] == roots["node"]).select("fp", "root", "first_id")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("smallest"))
    grouped = linked.join(smallest, "root").select("fp", "root", "smallest")
    # Written, so that the join reads plain shuffles and splits a hot fingerprint.
    named = written(prints.join(grouped, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("smallest", "first_id").alias("component_id")
    ), "named-prints")
    return rows.join(named, "fp").select("doc_id", "version", "fp", "root", "component_id")


def hex_print(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
