"""Document fingerprints as Merkle trees, in DataFrame functions only.

A text is a tree: sections (ended by a blank line) of paragraphs (ended by a
newline) of runs, which are up to RUN_WORDS words of a sentence (ended by a full
stop, a question or an exclamation mark and a space). No character is left out, so
the runs joined are the text. A run's digest is that of its text, any other node's
that of its children's digests, so two roots are equal if the texts are, and where
they differ, so do the nodes on the way down to the edit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import written

SECTION_END = r"(?<=\n\n)(?=[^\n])"
PARAGRAPH_END = r"(?s)(?<=\n)(?=.)"
SENTENCE_END = r"(?s)(?<=[.!?] )(?=.)"
RUN_WORDS = 4
#: Words with the spaces after them, or spaces at the begin; an empty text is one run.
RUN = rf"(?:[^ ]+ *){{1,{RUN_WORDS}}}| +|^$"
#: Hex digits of a run's digest in a printed fingerprint.
LEAF_DIGITS = 8
#: Repeated rows that travel as one.
LOT = 1000


def leaves(text: Column) -> Column:
    """Digests of runs in paragraphs in sections; a null text is an empty one."""
    in_sentence = lambda part: F.regexp_extract_all(part, F.lit(RUN), F.lit(0))
    runs = lambda part: F.transform(
        F.flatten(F.transform(F.split(part, SENTENCE_END), in_sentence)), lambda run: F.md5(run)
    )
    paragraphs = lambda part: F.transform(F.split(part, PARAGRAPH_END), runs)
    return F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_END), paragraphs)


def _paragraph(digests: Column) -> Column:
    return F.md5(F.concat(F.lit("p"), F.array_join(digests, "")))


def _section(paragraphs: Column) -> Column:
    return F.md5(F.concat(F.lit("s"), F.array_join(F.transform(paragraphs, _paragraph), "")))


def root(tree: Column) -> Column:
    """The root's digest, 64 hex digits, of the digests that leaves() gives."""
    return F.sha2(F.concat(F.lit("d"), F.array_join(F.transform(tree, _section), "")), 256)


def printed(tree: Column) -> Column:
    """The fingerprint as text: root, and after a colon the runs' digests, shortened,
    with "." after a paragraph and "/" after a section."""
    short = lambda s: F.substring(s, 1, LEAF_DIGITS)
    paragraph = lambda p: F.concat(F.array_join(F.transform(p, short), ""), F.lit("."))
    section = lambda s: F.concat(F.array_join(F.transform(s, paragraph), ""), F.lit("/"))
    return F.concat(root(tree), F.lit(":"), F.array_join(F.transform(tree, section), ""))


def likeness(one: Column, other: Column) -> Column:
    """How much two fingerprints share, from 0 to 1: twice the number of different runs
    that both have, over the sum of each one's, by the digits that are printed."""
    short = lambda tree: F.transform(F.flatten(F.flatten(tree)), lambda s: F.substring(s, 1, LEAF_DIGITS))
    a, b = (F.array_distinct(short(tree)) for tree in (one, other))
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def merkle_nodes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, section, paragraph, run, digest): the nodes of each document's tree.

    Places count from 0; they are null for levels below the node, so the root has
    none. A null text has the tree of an empty one, a single empty run. Rows with
    the same id give nodes each.
    """
    trees = docs.select(F.col(doc_id).alias("doc_id"), leaves(F.col(text)).alias("tree"))
    none = F.lit(None).cast("int")
    sections = trees.select("doc_id", F.posexplode("tree").alias("section", "below"))
    paragraphs = sections.select("doc_id", "section", F.posexplode("below").alias("paragraph", "below"))
    runs = paragraphs.select("doc_id", "section", "paragraph", F.posexplode("below").alias("run", "digest"))
    at = lambda name, known: F.col(name) if known else none.alias(name)
    levels = [
        (trees, 0, root(F.col("tree"))), (sections, 1, _section(F.col("below"))),
        (paragraphs, 2, _paragraph(F.col("below"))), (runs, 3, F.col("digest")),
    ]
    parts = [
        rows.select(
            "doc_id", at("section", n > 0), at("paragraph", n > 1), at("run", n > 2), digest.alias("digest")
        ) for rows, n, digest in levels
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def edits(one: Column, other: Column) -> Column:
    """Where two trees (of leaves()) differ: array of (section, paragraph, run).

    Equal branches are passed over whole. A place is null below a branch that only
    one of the trees has.
    """
    place = lambda s, p, k: F.struct(
        F.lit(s).cast("int").alias("section"), F.lit(p).cast("int").alias("paragraph"), F.lit(k).cast("int").alias("run")
    )
    empty = F.array().cast("array<struct<section:int,paragraph:int,run:int>>")

    def differing(a: Column, b: Column, below) -> Column:
        """below(place, child of a, child of b) for the children that differ."""
        count = F.greatest(F.size(a), F.size(b))
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(
            places, lambda k: F.when(F.get(a, k).eqNullSafe(F.get(b, k)), empty).otherwise(below(k, F.get(a, k), F.get(b, k)))
        ))

    def in_paragraph(s, p, a, b):
        return differing(a, b, lambda k, _x, _y: F.array(place(s, p, k)))

    def in_section(s, a, b):
        return differing(a, b, lambda p, x, y: F.when(x.isNull() | y.isNull(), F.array(place(s, p, None))).otherwise(in_paragraph(s, p, x, y)))

    return differing(one, other, lambda s, x, y: F.when(x.isNull() | y.isNull(), F.array(place(s, None, None))).otherwise(in_section(s, x, y)))


def _text_key(doc_id: Column, version: Column) -> Column:
    """One value for an id, which may be null, and a text's hash."""
    return F.concat_ws("/", version.cast("string"), doc_id.cast("string"))


def _in_order(keys: DataFrame) -> DataFrame:
    """(key, doc_id, n, next_key) of different (key, doc_id, version, n), in the order of
    with_next. Keys are dealt to ranges of about equal size, whatever values they have;
    the last of a range is followed by the first of the next one."""
    down = [F.desc_nulls_last("doc_id"), F.desc("version")]
    ranged = keys.repartitionByRange(*down).withColumn("part", F.spark_partition_id())
    placed = written(ranged, "documents-in-order")
    order = Window.partitionBy("part").orderBy(*down)
    inner = placed.withColumns({"inner": F.lead("key").over(order), "nth": F.row_number().over(order)})
    # A row for each range.
    parts = Window.orderBy("part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = inner.where("nth = 1").select("part", "key")
    after = firsts.select(
        F.col("part").alias("last_part"), F.coalesce(F.lead("key").over(parts), F.first("key").over(whole)).alias("after")
    )
    joined = inner.join(after, (F.col("part") == F.col("last_part")) & F.col("inner").isNull(), "left")
    return joined.select("key", "doc_id", "n", F.coalesce("inner", "after").alias("next_key"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", result: str = "next_text") -> DataFrame:
    """(doc_id, text, result): each document's text and that of the next document.

    The order is by doc_id, of any type that has one, descending, ties by a hash of the
    text; rows without doc_id come last, in the order of that hash. After the last comes
    the first. Repeated rows follow one another. Null texts are read as empty.

    Ids and hashes are put in order without the texts. Each different text is then
    brought to its own place and, by a second join, to the place before; repeated rows
    travel as a number, in lots of LOT.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("version", F.xxhash64("text")).withColumn("key", _text_key(F.col("doc_id"), F.col("version")))
    keys = rows.groupBy("key", "doc_id", "version").agg(F.count("*").alias("n"))
    places = written(_in_order(keys).withColumn(
        "lot", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / LOT).cast("int")))
    ), "next-documents")
    # One exchange of the texts serves both joins, as both take the same columns of it.
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    own = places.join(texts, "key")
    following = texts.select(F.col("key").alias("next_key"), F.col("text").alias("following"))
    copies = F.least(F.lit(LOT), F.col("n") - (F.col("lot") - 1) * LOT).cast("int")
    each = own.join(following, "next_key").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    last = (F.col("lot") - 1) * LOT + F.col("copy") == F.col("n")
    return each.select("doc_id", "text", F.when(last, F.col("following")).otherwise(F.col("text")).alias(result))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by the first characters of another."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))
