"""Line dedup with two Bloom filters.

1. Each task hashes the keys of its lines and sends on each different hash of a
   batch once, with a mark if several of the batch's documents have it.
2. The once-seen filter, cut into shards by hash, says which hashes come again;
   these fill the twice-seen filter, whose size is fixed.
3. The twice-seen filter is broadcast. Only lines that it lets through are
   shuffled, with their text, to count their documents exactly and to choose the
   one that keeps them.
4. The lines to drop come back to their documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.bloom import build_filter, seen_again
from tallyhouse.llm.common import as_bytes, free_name, written

BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
#: Bits of the broadcast filter of repeated lines: 16 MiB. Beyond some 10 million
#: repeated lines it lets more unrepeated ones through, which costs shuffle only.
REPEAT_BITS = 1 << 27


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def keys_of(text: bytes | None, min_chars: int) -> set[bytes]:
    """The different keys of a text that are long enough to count."""
    found = set(map(line_key, (text or b"").split(b"\n")))
    return {k for k in found if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)}


def hash_key(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key)


def _hashed(min_chars):
    def hashes(batches):
        for batch in batches:
            seen = [hash_key(k) for text in batch.column(0).to_pylist() for k in keys_of(text, min_chars)]
            found, count = np.unique(np.array(seen, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"h": pa.array(found.view(np.int64), pa.int64()), "again": pa.array(count > 1, pa.bool_())}
            )

    return hashes


def _suspects(filter_sent, min_chars):
    def suspects(batches):
        twice = filter_sent.value
        for batch in batches:
            keys, owners = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = keys_of(text, min_chars)
                keys.extend(own)
                owners.extend([row] * len(own))
            keep = np.flatnonzero(twice.may_hold(np.array(list(map(hash_key, keys)), np.uint64).view(np.int64)))
            rows = pa.array(np.array(owners, np.int64)[keep], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([keys[i] for i in keep], pa.binary()).cast(pa.string()),
                "doc_id": batch.column("doc_id").take(rows), "version": batch.column("version").take(rows),
            })

    return suspects


def _without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    kept, n_lines, n_dropped = [], [], []
    for text, drop in zip(texts.to_pylist(), drops.to_pylist()):
        lines = (text or b"").split(b"\n")
        n_lines.append(len(lines))
        if drop:
            gone = {key.encode() for key in drop}
            left = [line for line in lines if line_key(line) not in gone]
            n_dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left))
        else:
            n_dropped.append(0)
            kept.append(text)
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
        names=["kept", "n_lines", "n_dropped"],
    )


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, repeat_bits: int = REPEAT_BITS,
) -> DataFrame:
    """(doc_id, version, drop): for each document that loses lines, their keys.

    doc_id and version are those of common.identified.
    """
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), as_bytes(F.col(text)).alias("text")
    )
    hashes = written(source.select("text").mapInArrow(_hashed(min_chars), "h long, again boolean"), "line-hashes")
    twice = build_filter(seen_again(hashes, hashes.count()), repeat_bits)
    sent = docs.sparkSession.sparkContext.broadcast(twice)
    schema = f"key string, doc_id {dict(source.dtypes)['doc_id']}, version long"
    suspects = written(source.mapInArrow(_suspects(sent, min_chars), schema), "suspect-lines")
    # Written, so that the join reads plain shuffles and splits a line that many share.
    decided = written(
        suspects.groupBy("key")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs).select("key", "keeper"), "repeated-lines",
    )
    return (
        suspects.join(decided, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "version").agg(F.collect_set("key").alias("drop"))
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, repeat_bits: int = REPEAT_BITS, result: str = "deduped",
) -> DataFrame:
    """The documents with a struct column `result` (kept, n_lines, n_dropped).

    A text is split at newlines; the key of a line is the line without ASCII white
    space at its ends and with A-Z in lower case. A key of at least min_chars code
    points that at least min_docs different doc_ids have is dropped, with all its
    lines, from every document but the one with the largest doc_id, which keeps
    all of them. kept has the other lines, joined by newlines.

    A null or empty text is one empty line; kept is null for a null one. Rows with
    one doc_id count as one document. Rows without doc_id do not count and never
    keep a dropped line. A column that has the name of the result is replaced.
    """
    gone = repeated_lines(docs, doc_id, text, min_chars, min_docs, repeat_bits)
    docs = docs.drop(result)
    key, version = free_name(docs, "line_doc"), free_name(docs, "line_version")
    rows = docs.withColumns({key: F.col(doc_id), version: F.xxhash64(F.col(text))})
    drops = gone.select(
        F.col("doc_id").alias("drop_doc"), F.col("version").alias("drop_version"), F.col("drop").alias("drop_keys")
    )
    without = F.arrow_udf(_without, "kept string, n_lines long, n_dropped long")
    joined = rows.join(
        drops, rows[key].eqNullSafe(drops["drop_doc"]) & (rows[version] == drops["drop_version"]), "left"
    )
    return joined.select(
        *[rows[name] for name in docs.columns],
        without(as_bytes(rows[text]), drops["drop_keys"]).alias(result),
    )
