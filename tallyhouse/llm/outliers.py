"""Quality rules: base counts of a text, and robust multivariate outliers, in
DataFrame functions only.

The counts become a vector of five statistics. For each language and source the
minimum covariance determinant is sought: the three quarters of the vectors whose
covariance has the least determinant, by concentration steps, each of which takes
the vectors nearest to the last estimate. A text goes if its Mahalanobis distance
from that estimate is beyond what nearly all of a normal distribution reach.

Statistics are whole numbers, so sums are exact and the estimates do not depend on
how rows are dealt to tasks. Equal vectors count once: copies of a text, however many,
weigh as much as one. A step is one aggregate by group and distance bin, a few
numbers a group, so neither a group nor its distances are ever brought together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
FEWEST_WORDS = 50
MOST_REPEATED = 50
#: Statistics and what they may vary by at least (a standard deviation): texts of one
#: kind may all lack symbols and repeats, and a covariance has to be there nonetheless.
LEAST_SPREAD = {"length": 0.75, "word_length": 0.05, "symbols": 0.3, "dup_lines": 1.0, "repeats": 0.7}
#: A least spread in the units of the vectors.
UNIT = 1000
#: Share of the vectors whose determinant is minimal.
SUBSET = 0.75
#: What the covariance of that share of a normal distribution in five dimensions has
#: to be multiplied by to be that of the whole: SUBSET / P(chi2(7) < 6.6257).
CONSISTENCY = 1.412
#: Vectors of the least spread that each group's covariance is mixed with.
PRIOR_ROWS = 20
STEPS = 8
#: Squared distance beyond which one in 100,000 of a normal distribution lies: the
#: quantile 0.99999 of chi2(5).
FARTHEST = 30.86
#: Bins for each doubling of one plus a squared distance.
BINS = 32
#: Vectors of a group that share a task in a join.
SALT_ROWS = 50_000

NAMES = list(LEAST_SPREAD)
P = len(NAMES)


def _let(value: Column, use) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of three words that the text has twice or more.

    Windows are compared by a 64-bit hash. Where no two are equal nothing is sorted.
    """
    hashes = lambda ws: F.slice(
        F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2))), F.lit(1), F.greatest(F.size(ws) - (WINDOW - 1), F.lit(0))
    )
    same = lambda a, e, k: F.coalesce(F.get(a, k)["h"] == e["h"], F.lit(False))
    places = lambda a: F.array_sort(F.transform(
        F.filter(a, lambda e, k: same(a, e, k - 1) | same(a, e, k + 1)), lambda e: e["i"]
    ))
    covered = lambda p: F.aggregate(
        F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))), F.lit(0), lambda x, y: x + y
    )
    ordered = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    count = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
        _let(_let(ordered(h), places), covered)
    )
    return _let(words, lambda ws: F.when(F.size(ws) < WINDOW, 0).otherwise(_let(hashes(ws), count))).cast("long")


def base_counts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    return {
        "n_words": F.size(words_of(text)).cast("long"),
        "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words_of(text)),
    }


def fails_base() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The vector of a text that passes the base rules, in thousandths of the least
    spread: logarithms of its length, of its words' length, and of shares of it."""
    n, chars = F.col("n_words"), F.col("word_chars")
    plain = {
        "length": F.log(n), "word_length": F.log(chars / n), "symbols": F.log1p(100 * F.col("n_symbols") / chars),
        "dup_lines": F.log1p(1000 * F.col("n_dup_lines") / n), "repeats": F.log1p(100 * F.col("n_repeat_words") / n),
    }
    return {name: F.when(~F.col("base_failed"), F.round(value * (UNIT / LEAST_SPREAD[name])).cast("long")) for name, value in plain.items()}


def _estimate(rows: DataFrame) -> DataFrame:
    """Rows with a group's centre m0.. and covariance c00, c10, .. (in least spreads) to
    (group, salts, m0.., w00, w10, ..): w is the inverse of the covariance's root."""
    for i in range(P):
        for j in range(i + 1):
            known = reduce(lambda x, y: x + y, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            rest = F.col(f"c{i}{j}") - known
            rows = rows.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    for j in range(P):
        for i in range(j, P):
            known = reduce(lambda x, y: x + y, [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)], F.lit(0.0))
            rows = rows.withColumn(f"w{i}{j}", ((F.lit(1.0) if i == j else F.lit(0.0)) - known) / F.col(f"l{i}{i}"))
    return rows.select("group", "salts", *[f"m{i}" for i in range(P)], *[f"w{i}{j}" for i in range(P) for j in range(i + 1)])


def _squared_distance() -> Column:
    """Of a vector from its group's estimate, both in one row."""
    off = [(F.col(name) / UNIT - F.col(f"m{i}")) for i, name in enumerate(NAMES)]
    along = [reduce(lambda x, y: x + y, [F.col(f"w{i}{j}") * off[j] for j in range(i + 1)]) for i in range(P)]
    return reduce(lambda x, y: x + y, [x * x for x in along])


def _salted(estimates: DataFrame) -> DataFrame:
    """A row of a group's estimate for each of its salts."""
    return estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _medians(points: DataFrame) -> DataFrame:
    """First estimate: medians and, without correlations, spreads of the middle half."""
    quarters = points.groupBy("group", "salts").agg(*[
        F.percentile(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, name in enumerate(NAMES)
    ])
    spread = lambda i: (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / (UNIT * 1.349)
    return quarters.select(
        "group", "salts", *[(F.col(f"q{i}")[1] / UNIT).alias(f"m{i}") for i in range(P)],
        *[(F.lit(1.0) + spread(i) * spread(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)],
    )


def _concentrated(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """Centre and covariance of the SUBSET of each group that is nearest to its estimate.

    Vectors as far as the last of the subset, up to the width of a bin, are in it.
    """
    away = points.drop("salts").join(_salted(estimates), ["group", "salt"]).withColumn(
        "bin", F.floor(BINS * F.log2(1 + _squared_distance())).cast("int")
    )
    sums = {"n": F.count("*")} | {f"s{i}": F.sum(NAMES[i]) for i in range(P)}
    sums |= {f"s{i}{j}": F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i in range(P) for j in range(i + 1)}
    by_bin = away.groupBy("group", "bin").agg(*[what.alias(name) for name, what in sums.items()])
    nearer = Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("group")
    inside = by_bin.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).withColumn("all", F.sum("n").over(whole)).where(
        F.col("before") < F.ceil(F.col("all") * SUBSET)
    )
    total = inside.groupBy("group").agg(*[F.sum(name).cast("double").alias(name) for name in sums])
    mean = lambda i: F.col(f"s{i}") / F.col("n")

    def covariance(i: int, j: int) -> Column:
        own = (F.col(f"s{i}{j}") / F.col("n") - mean(i) * mean(j)) / UNIT ** 2
        prior = 1.0 if i == j else 0.0
        mixed = (own * F.col("n") + PRIOR_ROWS * prior) / (F.col("n") + PRIOR_ROWS)
        return CONSISTENCY * mixed + prior

    found = total.select(
        F.col("group"), *[(mean(i) / UNIT).alias(f"m{i}") for i in range(P)],
        *[covariance(i, j).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)],
    )
    return found.join(estimates.select("group", "salts"), "group")


def estimated(points: DataFrame, steps: int = STEPS) -> DataFrame:
    """The estimate of each group after so many steps, written; `points` are vectors with
    group, salt and salts."""
    estimates = written(_estimate(_medians(points)), "first-estimates")
    for _ in range(steps):
        estimates = written(_estimate(_concentrated(points, estimates)), "estimates")
    return estimates


def quality(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", steps: int = STEPS,
) -> DataFrame:
    """(doc_id, the base counts, base_failed, distance, kept), a row for each document.

    A null text has no words. A null language or source is one of its own. Texts that
    fail the base rules are not part of an estimate and have no distance. In a group
    of few different texts the least spread outweighs what they tell, so hardly any goes.
    """
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s"))).alias("group"),
        *[count.alias(name) for name, count in base_counts(F.col(text)).items()],
    ).withColumn("base_failed", fails_base())
    rows = written(counted.withColumns(statistics()), "text-statistics")
    different = written(rows.where("not base_failed").select("group", *NAMES).distinct(), "different-statistics")
    sizes = written(different.groupBy("group").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "group-sizes")
    salt = F.pmod(F.xxhash64(*NAMES), F.col("salts")).cast("int")
    points = written(different.join(sizes, "group").withColumn("salt", salt), "salted-statistics")
    estimates = estimated(points, steps).drop("salts")
    far = rows.join(estimates, "group", "left").withColumn("distance", _squared_distance())
    return far.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(~F.col("base_failed"), F.sqrt("distance")).alias("distance"),
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= FARTHEST, F.lit(True))).alias("kept"),
    )
