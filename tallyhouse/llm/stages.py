"""Text operators as stages of a corpus pipeline: documents in, documents out.

A stage takes (spark, docs, sf_dir) and decides over all the documents it gets. All
but the last return the columns of documents they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.common import free_name, table, written
from tallyhouse.llm.decontam import contamination
from tallyhouse.llm.langid import fit_profiles, guess_language, least_scores, trained_rows
from tallyhouse.llm.lines import dedup_lines
from tallyhouse.llm.pieces import encode_decode
from tallyhouse.llm.simhash import near_groups

PIECE_MODEL = "piece_bpe_32k.model"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach. Those without
    a letter go, so do null and empty texts, and those less like their nearest
    language than its labelled documents are, by far. Each text is scored once."""
    profiles = fit_profiles(docs.where(trained_rows(docs)))
    guess = free_name(docs, "guess")
    marked = written(docs.withColumn(guess, guess_language(F.col("text"), profiles)), "language-guesses")
    least = least_scores(marked.where(trained_rows(marked)), profiles, guess)
    known = F.lit(False)
    for lang, score in least.items():
        known = known | ((F.col(guess)["lang"] == lang) & (F.col(guess)["score"] >= score))
    return marked.where(known).drop(guess)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another one keeps; n_chars, where there
    is one, is that of the new text. A document may be left without text."""
    result = free_name(docs, "deduped")
    rows = dedup_lines(docs, result=result).withColumn("text", F.col(result)["kept"]).drop(result)
    if "n_chars" not in rows.columns:
        return rows
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest doc_id.

    A row that is repeated stays once; of different texts with this one id, the one
    with the smallest hash stays. Rows without doc_id go if their group has an id; of
    a group without any, the text with the smallest hash stays, once.
    """
    marked = near_groups(docs).withColumn("stays", F.coalesce(F.col("component_id") == F.col("doc_id"), F.col("component_id").isNull()))
    rows = written(marked.select("doc_id", "version", "root", "stays"), "near-decisions")
    repeated = written(
        rows.where("stays and doc_id is not null").groupBy("doc_id")
        .agg(F.min("version").alias("first"), F.count("*").alias("n")).where("n > 1"), "repeated-ids",
    )
    others = rows.where("stays").join(repeated, "doc_id").where("version <> first")
    unnamed = written(
        rows.where("stays and doc_id is null").groupBy("root", "doc_id", "version").agg(F.count("*").alias("n")), "unnamed-texts"
    )
    firsts = written(unnamed.groupBy("root").agg(F.min(F.struct("version", "n")).alias("of")).select("of.*"), "unnamed-firsts")
    gone = rows.where("not stays").select("doc_id", "version").union(others.select("doc_id", "version")).union(
        unnamed.join(firsts, "version", "left_anti").select("doc_id", "version")
    ).select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version")).distinct()
    kept = docs.join(
        gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_version"]), "left_anti"
    )
    again = written(repeated.select(F.col("doc_id").alias("repeated_id"), F.col("first").alias("repeated_version")).union(
        firsts.where("n > 1").select(F.lit(None).cast(docs.schema["doc_id"].dataType), "version")
    ), "repeated-rows")
    if again.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(again["repeated_id"]) & (F.xxhash64(kept["text"]) == again["repeated_version"])
    version = free_name(docs, "version")
    several = kept.join(again, same, "left_semi").withColumn(version, F.xxhash64("text"))
    return kept.join(again, same, "left_anti").unionByName(several.dropDuplicates(["doc_id", version]).drop(version))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Each text is decided
    by itself, also where others have its doc_id or none has one."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    hit = found.select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version")).distinct()
    return docs.join(
        hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_version"]), "left_anti"
    )


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document."""
    coded = encode_decode(F.col("text"), public_tokenizers.path(PIECE_MODEL))
    return docs.select("doc_id", coded.alias("coded")).select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("coded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded"), 256).alias("decoded_sha256"), F.col("coded.ids").alias("ids"),
    )
