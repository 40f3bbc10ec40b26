import random

import duckdb
import numpy as np
import pytest
from brute import EDGES, documents, top_grams
from pyspark.sql import functions as F

from tallyhouse.llm import langid
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.stages import known_language

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def profiles(spark):
    docs = spark.read.parquet(DOCUMENTS)
    return langid.fit_profiles(docs.where(langid.trained_rows(docs)))


def test_distances_are_those_of_profiles_as_lists(spark, profiles):
    """Out-of-place distance by definition, from profiles made by counting strings."""
    rows = duckdb.sql(f"select lang, text from '{DOCUMENTS}' where doc_id % 40 = 1").fetchall()
    as_text = {}
    for gram, ranks in zip(profiles.grams.tolist(), profiles.ranks):
        letters = "".join(chr(gram >> 21 * k & 0x1FFFFF) for k in (2, 1, 0) if gram >> 21 * k & 0x1FFFFF)
        as_text[letters] = ranks
    for _, text in rows:
        top = top_grams(text)
        want = np.array([
            sum(abs(as_text[g][k] - r) if g in as_text and as_text[g][k] >= 0 else profiles.profile for r, g in enumerate(top))
            for k in range(len(profiles.langs))
        ])
        found, counts = langid.gram_counts(langid.letters_of(text))
        assert (profiles.distances(langid.ranked(found, counts, profiles.profile)) == want).all()


def test_profiles_are_the_most_frequent_grams_of_training(spark):
    rows = [(1, "aaa ab", "x"), (2, "ab", "x"), (3, "ba", "y"), (4, "zz", None)]
    fitted = langid.fit_profiles(documents(spark, rows), profile=5)
    assert fitted.langs == ["x", "y"]
    gram = lambda s: sum(ord(c) << 21 * k for k, c in enumerate(reversed(s)))
    ranks = dict(zip(fitted.grams.tolist(), fitted.ranks.tolist()))
    assert ranks[gram("a")][0] == 0
    assert gram("z") not in ranks
    assert sorted(r[0] for r in ranks.values() if r[0] >= 0) == [0, 1, 2, 3, 4]


def test_repeats_of_a_text_count_once_in_training(spark):
    rng = np.random.default_rng(4)
    rows = [(n, " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(30)), "x") for n in range(100)]
    once = langid.fit_profiles(documents(spark, rows), train_docs=20)
    for _, text, _ in rows[:2]:
        again = langid.fit_profiles(documents(spark, [*rows, *[(7, text, "x")] * 300]), train_docs=20)
        assert (again.grams == once.grams).all() and (again.ranks == once.ranks).all()


def test_held_out_accuracy(spark):
    truth = dict(duckdb.sql(f"select doc_id, lang from '{DOCUMENTS}'").fetchall())
    rows = [r for r in QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()]
    held_out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held_out) > 200
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held_out) >= 0.98 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, profiles):
    guess = langid.guess_language(F.col("text"), profiles)
    rows = documents(spark).withColumn("guess", guess).select("text", "guess.*").collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        assert (row["lang"] == "und") == (not any(map(str.isalpha, row["text"] or "")))
        assert 0 <= row["score"] <= 1


def test_without_labelled_rows(spark):
    for rows in ([], [(1, "some text", None)]):
        fitted = langid.fit_profiles(documents(spark, rows))
        assert fitted.guess("some text") == ("und", 0.0)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    words = langid.letters_of("the quick brown fox " * 50)
    whole = langid.gram_counts(words)
    monkeypatch.setattr(langid, "PIECE", 7)
    pieces = langid.gram_counts(words)
    assert all((a == b).all() for a, b in zip(whole, pieces))


@pytest.mark.parametrize("count", [2, 40, 49, 51, 80])
def test_the_cut_moves_on_evenly_with_the_number_of_labelled_documents(spark, count):
    """Texts of the language stay and random letters go, however few are labelled, on both
    sides of PRIOR."""
    rng = random.Random(count)
    words = ["the", "then", "that", "other", "there", "with", "thing", "and", "hand", "stand"]
    text = lambda: " ".join(rng.choice(words) for _ in range(60))
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60))
    rows = [(n, text(), "en") for n in range(count)] + [(1000, text(), None), (1001, noise, None), (1002, "1 2 3", None), (None, text(), None)]
    kept = known_language(spark, documents(spark, rows), "")
    assert sorted(r.doc_id for r in kept.where("doc_id >= 1000").collect()) == [1000]
    assert kept.where("doc_id is null").count() == 1 and kept.where("doc_id < 1000").count() == count
