"""Language ID by rank-order profiles.

A language's profile is the list of its most frequent n-grams (one to three
letters, with word ends), by rank. A document's own most frequent n-grams are
compared with each profile: the out-of-place distance adds, for each of them, how
far its rank is from its rank in the profile, or the profile's length if it is
not there. The language with the smallest distance is the answer.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: N-grams in a profile.
PROFILE = 300
#: The model is fitted on about so many different texts of each language, chosen by
#: a hash of the text.
TRAIN_DOCS = 2000
UNKNOWN = "und"
#: A text is in none of the languages if its score is under LEAST_SHARE of the one that
#: all but LOW of its language's labelled documents reach.
#: Labelled documents count with PRIOR others whose least score is LEAST_SCORE, so a few
#: labels reject little, and each more tells as much as the one before.
LOW = 0.01
LEAST_SHARE = 0.6
PRIOR = 50
LEAST_SCORE = 0.1
SPACE = 32
#: Code points that are counted at a time; longer texts are counted in pieces.
PIECE = 1 << 20

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """The words of a text in lower case, each between spaces; empty without letters."""
    words = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def gram_counts(words: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to three code points and how often each occurs.

    An n-gram is a number of 21 bits a code point. None reaches over a word's end.
    """
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(words), PIECE):
        # Two more code points end the n-grams that begin in this piece.
        piece = words[start:start + PIECE + 2]
        point = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        own = min(PIECE, len(point))
        one = point[:own][point[:own] != SPACE]
        two = ((point[:-1] << 21) | point[1:])[:own]
        three = (point[:-2] << 42) | (point[1:-1] << 21) | point[2:]
        three = three[:own][point[1:-1][:own] != SPACE]
        new, n = np.unique(np.concatenate([one, two, three]), return_counts=True)
        if len(found):
            both, where = np.unique(np.concatenate([found, new]), return_inverse=True)
            n = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
            new = both
        found, counts = new, n
    return found, counts


def ranked(found: np.ndarray, counts: np.ndarray, profile: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by number."""
    return found[np.argsort(-counts, kind="stable")[:profile]]


@dataclass
class Profiles:
    """Ranks of n-grams (rows, sorted by n-gram) in languages (columns)."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    profile: int

    def distances(self, top: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked n-grams to each language."""
        where = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        ranks = np.where((self.grams[where] == top)[:, None], self.ranks[where], -1)
        apart = np.abs(ranks - np.arange(len(top))[:, None])
        return np.where(ranks < 0, self.profile, apart).sum(axis=0)

    def guess(self, text: str | None) -> tuple[str, float]:
        words = letters_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0
        top = ranked(*gram_counts(words), self.profile)
        distances = self.distances(top)
        best = int(np.argmin(distances))
        return self.langs[best], float(1 - distances[best] / (self.profile * len(top)))


def _counted(batches):
    """Partial counts: one row for each language and n-gram of a batch."""
    for batch in batches:
        parts: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            parts.setdefault(lang, []).append(gram_counts(letters_of(text)))
        for lang, counted in parts.items():
            found, where = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n for _, n in counted]), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(found), pa.string()),
                "gram": pa.array(found, pa.int64()), "n": pa.array(n, pa.int64()),
            })


def fit_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", profile: int = PROFILE, train_docs: int = TRAIN_DOCS
) -> Profiles:
    """Profiles from labelled documents; rows without language are left out.

    Of each language about train_docs different texts are used, chosen by their hash,
    whole; repeats of a text count once. The driver gets one number for each language
    and the finished profiles. Without labelled rows every guess is `und`.
    """
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null")
    labelled = labelled.withColumn("version", F.xxhash64("text"))
    shares = [
        (row["lang"], min(1.0, train_docs / row["n"]))
        for row in labelled.select("lang", "version").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()
    ]
    if not shares:
        return Profiles([], np.zeros(0, np.int64), np.zeros((0, 0), np.int64), profile)
    share = F.create_map(*[F.lit(value) for pair in shares for value in pair])[F.col("lang")]
    drawn = F.pmod("version", F.lit(1 << 20)) < share * (1 << 20)
    different = labelled.where(drawn).dropDuplicates(["lang", "version"]).select("lang", "text")
    counts = (
        different.mapInArrow(_counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("place", place).where(F.col("place") <= profile).select("lang", "gram", "place").collect()
    langs = sorted({row["lang"] for row in rows})
    grams = np.array(sorted({row["gram"] for row in rows}), np.int64)
    ranks = np.full((len(grams), len(langs)), -1, np.int64)
    for row in rows:
        ranks[np.searchsorted(grams, row["gram"]), langs.index(row["lang"])] = row["place"] - 1
    return Profiles(langs, grams, ranks, profile)


def guess_language(text: Column, profiles: Profiles) -> Column:
    """(lang, score) of a text.

    lang is `und` for a text that is null or has no letter, else one of the fitted
    languages, the first by name among equally near ones. score is 1 less the
    distance as a share of the greatest there can be, so from 0 to 1.
    """

    @F.arrow_udf("lang string, score double")
    def guess(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for text in texts:
            lang, score = profiles.guess(text.as_py())
            langs.append(lang)
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return guess.asNondeterministic()(text)


def least_scores(guessed: DataFrame, profiles: Profiles, guess: str = "guess", lang: str = "lang") -> dict[str, float]:
    """For each fitted language the score that a text in it has at least.

    Taken from all the labelled documents that this language is the guess of (a label may
    be wrong, its text is one that was meant to be learnt), mixed with PRIOR others.
    """
    labelled = guessed.where(F.col(lang).isNotNull())
    low = labelled.groupBy(F.col(guess)["lang"].alias("known")).agg(
        F.count("*").alias("n"), F.percentile_approx(F.col(guess)["score"], LOW).alias("low")
    )
    found = {row["known"]: (row["n"], row["low"]) for row in low.where(F.col("known") != UNKNOWN).collect()}
    counts = {name: found.get(name, (0, 0.0)) for name in profiles.langs}
    return {name: (n * LEAST_SHARE * score + PRIOR * LEAST_SCORE) / (n + PRIOR) for name, (n, score) in counts.items()}


def trained_rows(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """Whether a document is for learning: crc32 of its id, as text, mod 3 is not 1. A null
    id reads as an empty text, whose remainder is 0, so such a document is."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 != 1
