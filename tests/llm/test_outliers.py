"""Quality rules against plain Python, and the estimates against numpy."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import EDGES, documents
from tallyhouse.llm import outliers
from tallyhouse.llm.outliers import quality, repeated_words, words_of
from tallyhouse.llm.queries import op13_quality_outliers

WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[n:n + 3]) for n in range(len(words) - 2)]
    often = Counter(windows)
    hit = {k for n, w in enumerate(windows) if often[w] > 1 for k in (n, n + 1, n + 2)}
    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(n - 1 for n in lines.values()), len(hit)
    )


def vector(n, chars, symbols, dup, repeats):
    plain = [
        math.log(n), math.log(chars / n), math.log1p(100 * symbols / chars), math.log1p(1000 * dup / n), math.log1p(100 * repeats / n)
    ]
    return [math.floor(x * (1000 / spread) + 0.5) for x, spread in zip(plain, outliers.LEAST_SPREAD.values(), strict=True)]


def distances(points):
    """Distance function of the estimate over different vectors of a group."""
    points = np.array(sorted(set(map(tuple, points))), float) / 1000
    low, middle, high = np.percentile(points, [25, 50, 75], axis=0)
    centre, cov = middle, np.diag(1 + ((high - low) / 1.349) ** 2)
    for _ in range(outliers.STEPS):
        off = points - centre
        d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
        bins = np.floor(32 * np.log2(1 + d))
        inside = points[bins <= np.sort(bins)[math.ceil(0.75 * len(points)) - 1]]
        n, centre = len(inside), inside.mean(axis=0)
        own = np.atleast_2d(np.cov(inside.T, bias=True)) if n > 1 else np.zeros((5, 5))
        cov = outliers.CONSISTENCY * (own * n + 20 * np.eye(5)) / (n + 20) + np.eye(5)
    inverse = np.linalg.inv(cov)
    return lambda x: math.sqrt((np.array(x) / 1000 - centre) @ inverse @ (np.array(x) / 1000 - centre))


def brute(rows):
    """[(id, text, lang, source)] -> [(id, counts.., base_failed, distance, kept)]."""
    found = [(i, counts(text), (lang, source)) for i, text, lang, source in rows]
    failed = lambda c: c[0] < 50 or 100 * c[4] > 50 * c[0]
    groups = defaultdict(list)
    for _, c, group in found:
        if not failed(c):
            groups[group].append(vector(*c))
    away = {group: distances(points) for group, points in groups.items()}
    out = []
    for i, c, group in found:
        d = None if failed(c) else away[group](vector(*c))
        out.append((i, *c, failed(c), None if d is None else round(d, 6), d is not None and d * d <= outliers.FARTHEST))
    return sorted(out, key=repr)


def judged(found):
    rows = found.withColumn("distance", F.round("distance", 6)).collect()
    return sorted((tuple(row) for row in rows), key=repr)


def prose(rng, words, mark=""):
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) + mark for _ in range(words))


def test_edges(spark):
    long = " ".join(f"w{n % 4000} x{n}" for n in range(60_000)) + "\n# $"
    rows = [*EDGES, (20, long, "en"), (21, "\x0b ".join(["a b c d"] * 40), None), (22, " ".join(f"w{n}" for n in range(60)), None)]
    rows += [(30 + n, " ".join(f"w{n}{k}" for k in range(60 + n)), "en") for n in range(5)] * 2
    assert judged(quality(documents(spark, rows))) == brute([(i, text, lang, "src0") for i, text, lang in rows])


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert judged(op13_quality_outliers(spark, sf_dir)) == brute([(r.doc_id, r.text, r.lang, r.source) for r in docs])


def test_outliers_that_are_a_fifth_of_a_group_do_not_hide(spark):
    rng = np.random.default_rng(3)
    rows = [(n, prose(rng, int(rng.integers(60, 400))), "en", "s") for n in range(240)]
    rows += [(1000 + n, prose(rng, int(rng.integers(60, 400)), mark="$%"), "en", "s") for n in range(60)]
    rows += [(2000 + n, rows[-1][1], "en", "s") for n in range(400)]  # copies count once
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality(table).collect()}
    assert all(kept[n] for n in range(240)) and not any(kept[n] for n in kept if n >= 1000)


def test_salts_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(n, prose(rng, 60 + n), "en", None if n % 3 else "s") for n in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    one = judged(quality(table))
    monkeypatch.setattr(outliers, "SALT_ROWS", 7)
    assert judged(quality(table)) == one == brute(rows)


def test_empty(spark):
    assert quality(documents(spark, [])).count() == 0
    assert quality(documents(spark, [(1, None, "en")])).first().kept is False


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b c d e f a b c d", "a b", "", "x a b c y a b c z a b c"])
def test_repeated_words(spark, text):
    row = spark.createDataFrame([(text,)], "text string").select(repeated_words(words_of(F.col("text")))).first()
    assert row[0] == counts(text)[4]
