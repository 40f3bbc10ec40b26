"""Benchmark decontamination by winnowing.

Of every run of k-grams that fits a window, the one with the smallest hash is a
fingerprint of it, so two texts that share a window share a fingerprint at the
same place in it. Training and benchmark fingerprints are joined, and each hit is
extended word by word on both sides; it counts where it grows to a whole window.

A filter of the benchmark's fingerprints, of a fixed size, goes to every task, so
that only training fingerprints that may meet one are shuffled, each with the
words around it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.bloom import Filter, build_filter
from tallyhouse.llm.common import as_bytes, written

WINDOW = 10
GRAM = 5
#: Bits of the broadcast filter: 2 MiB, for some million fingerprints. More let
#: more training fingerprints through, which costs shuffle only.
FILTER_BITS = 1 << 24
#: Hashes of words that a worker remembers.
REMEMBERED = 300_000

# UTF-8 bytes of words, after A-Z are lowered: digits, a-z and all that is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


class _WordHashes(dict):
    """Hashes of words; forgets all when it has too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def _run_hashes(word: np.ndarray, gram: int) -> np.ndarray:
    """A hash for each run of so many words, from the hashes of the words."""
    n = len(word) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run = np.full(n, gram, np.uint64)
    for k in range(gram):
        run = run * _MULTIPLY + word[k:k + n]
    run ^= run >> np.uint64(32)
    run *= _MIX
    return run ^ (run >> np.uint64(29))


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of each so many neighbours, the last of equal ones."""
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place = grams[:n].copy(), np.arange(n)
    for k in range(1, window):
        other = grams[k:k + n]
        lower = other <= best
        best[lower] = other[lower]
        place[lower] = np.flatnonzero(lower) + k
    return np.unique(place)


def _prints(words: list[bytes], sizes: list[int], window: int, gram: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, hashes): the fingerprints for windows of these sizes.

    Whole windows are winnowed. Items with fewer words are one window each; for
    each of their sizes every run of so many words is a fingerprint.
    """
    if not words:
        return []
    word = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    found = []
    for size in sizes:
        length = gram if size == window else size
        grams = _run_hashes(word, length)
        places = winnow(grams, size - length + 1)
        found.append((size, places, grams[places].view(np.int64)))
    return found


_AT = "array<struct<h:bigint,size:int,place:int,before:array<string>,after:array<string>>>"


def _listed(found, words, window, gram) -> list[dict]:
    """Fingerprints with the words that can be in a window with them."""
    out = []
    for size, places, hashes in found:
        reach = window - gram if size == window else 0
        length = gram if size == window else size
        for place, h in zip(places.tolist(), hashes.tolist()):
            out.append({
                "h": h, "size": size, "place": place,
                "before": [w.decode() for w in words[max(0, place - reach):place]][::-1],
                "after": [w.decode() for w in words[place:place + length + reach]],
            })
    return out


_ARROW_AT = pa.list_(pa.struct([
    ("h", pa.int64()), ("size", pa.int32()), ("place", pa.int32()),
    ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
]))


def item_prints(items: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """(item_id, h, size, place, before, after) of benchmark items."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            words = words_of(text)
            size = min(window, len(words))
            out.append(_listed(_prints(words, [size] if size else [], window, gram), words, window, gram))
        return pa.array(out, _ARROW_AT)

    prints = F.arrow_udf(run, _AT)(as_bytes(F.col(text)))
    return items.select(F.col(item_id).alias("item_id"), F.explode(prints).alias("at")).select("item_id", "at.*")


def _suspects(sent, sizes, window, gram):
    def run(texts: pa.Array) -> pa.Array:
        known: Filter = sent.value
        counts, suspects = [], []
        for text in texts.to_pylist():
            words = words_of(text)
            counts.append(len(words))
            found = []
            for size, places, hashes in _prints(words, sizes, window, gram):
                may = known.may_hold(hashes)
                if may.any():
                    found.append((size, places[may], hashes[may]))
            suspects.append(_listed(found, words, window, gram))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(suspects, _ARROW_AT)], names=["n_words", "suspects"]
        )

    return run


def _extended(window, gram):
    def run(*columns: pa.Array) -> pa.Array:
        """The words of the document that a hit grows to, or null where it stays short."""
        spans = []
        for size, place, b, a, ib, ia in zip(*[column.to_pylist() for column in columns]):
            length = gram if size == window else size
            left = next((k for k, (x, y) in enumerate(zip(b, ib)) if x != y), min(len(b), len(ib)))
            right = next((k for k, (x, y) in enumerate(zip(a, ia)) if x != y), min(len(a), len(ia)))
            spans.append({"start": place - left, "end": place + right} if right >= length and left + right >= size else None)
        return pa.array(spans, pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    return run


def _covered(spans: pa.Array) -> pa.Array:
    """How many words sorted spans cover together."""
    out = []
    for row in spans.to_pylist():
        total, reached = 0, 0
        for span in row or ():
            total += max(0, span["end"] - max(reached, span["start"]))
            reached = max(reached, span["end"])
        out.append(total)
    return pa.array(out, pa.int64())


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, gram: int = GRAM, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, version, n_words, spans, n_hit, items), a row for each document.

    version is a hash of the text, as in common.identified. Words are runs of ASCII letters and digits and of all that is not ASCII, A-Z in
    lower case. A window is `window` consecutive words of an item; an item of fewer
    words, but at least one, is one window. spans are ranges of words [start, end)
    in which windows occur, n_hit is the number of words in them, and items are the
    ids of the items they come from, in order of their text.

    A null or empty text has no words. Rows with the same id and text get the same
    result each. An item without id marks words but is not in items; rows of items
    with the same id count as one. Without items nothing is hit.
    """
    prints = written(item_prints(items, item_id, item_text, window, gram), "item-prints")
    sizes = sorted(row["size"] for row in prints.select("size").distinct().collect())
    sent = docs.sparkSession.sparkContext.broadcast(build_filter(prints.select("h"), filter_bits))
    suspects = F.arrow_udf(_suspects(sent, sizes, window, gram), f"n_words long, suspects {_AT}").asNondeterministic()
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"),
            suspects(as_bytes(F.col(text))).alias("own"),
        ).select("doc_id", "version", "own.*"), "suspects",
    )
    at = rows.select("doc_id", "version", F.explode("suspects").alias("at")).select("doc_id", "version", "at.*")
    theirs = prints.select("h", "size", "item_id", F.col("before").alias("item_before"), F.col("after").alias("item_after"))
    extended = F.arrow_udf(_extended(window, gram), "start int, end int").asNondeterministic()
    hits = (
        at.join(theirs, ["h", "size"])
        .withColumn("span", extended("size", "place", "before", "after", "item_before", "item_after"))
        .where("span is not null")
        .groupBy("doc_id", "version")
        .agg(F.collect_set("span").alias("spans"), F.collect_set("item_id").alias("items"))
    )
    covered = F.arrow_udf(_covered, "long")
    found = hits.select(
        F.col("doc_id").alias("hit_doc"), F.col("version").alias("hit_version"), F.array_sort("spans").alias("spans"),
        F.array_sort(F.col("items").cast("array<string>")).alias("items"),
    ).withColumn("n_hit", covered("spans"))
    joined = rows.join(
        found, rows["doc_id"].eqNullSafe(found["hit_doc"]) & (rows["version"] == found["hit_version"]), "left"
    )
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "version", "n_words", "spans", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )
