"""One registered query for each text operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.codes import vector_codes, with_label_error
from tallyhouse.llm.common import table, written
from tallyhouse.llm.decontam import contamination
from tallyhouse.llm.langid import fit_profiles, guess_language, trained_rows
from tallyhouse.llm.lines import dedup_lines
from tallyhouse.llm.merkle import edited, leaves, likeness, printed, with_next
from tallyhouse.llm.outliers import quality
from tallyhouse.llm.pii import KINDS, pseudonymize
from tallyhouse.llm.secrets import BASE_KINDS, joined_spans, secret_spans
from tallyhouse.llm.simhash import hex_print, near_groups
from tallyhouse.llm.stages import as_pieces
from tallyhouse.llm.toxicity import PARTS, fit_severity, graded, labelled_sample, severity_of
from tallyhouse.llm.turns import damaged, digests, repair_conversations
from tallyhouse.llm.warc import derivatives

#: A deployment passes its own; with this one results can be compared.
PSEUDONYM_KEY = "pseudonyms of the registered query"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(_documents(spark, sf_dir), PSEUDONYM_KEY).select(
        "doc_id", F.col("private").alias("text"),
        *[F.coalesce(F.try_element_at("n_private", F.lit(kind)), F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir)).select(
        "doc_id", "deduped.n_lines", "deduped.n_dropped",
        F.sha2(F.coalesce("deduped.kept", F.lit("")), 256).alias("kept_sha256"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    profiles = fit_profiles(docs.where(trained_rows(docs)))
    return docs.select("doc_id", guess_language(F.col("text"), profiles).alias("guess")).select(
        "doc_id", (~trained_rows(docs)).alias("held_out"),
        F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    sample = written(labelled_sample(docs, table(spark, sf_dir, "labels")).repartition(PARTS), "labelled-sample")
    model = fit_severity(*graded(sample))
    return docs.select("doc_id", severity_of(F.col("text"), model).alias("of")).select("doc_id", "of.*")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_pieces(spark, _documents(spark, sf_dir), sf_dir).drop("ids")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    return secret_spans(_documents(spark, sf_dir)).select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"),
    )


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_documents(spark, sf_dir)).select(
        "doc_id", hex_print(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return derivatives(table(spark, sf_dir, "pages")).withColumn("headers", lines)


def op10_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(_documents(spark, sf_dir)).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    trees = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        *[leaves(F.col(name)).alias(tree) for tree, name in (("own", "text"), ("changed", "edited"), ("following", "next_text"))],
    )
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    turns, counts = repair_conversations(damaged(original), copies="copies")
    rows, audits = original.select("conv_id").distinct(), digests(turns)
    for found in (counts, audits):
        named = found.withColumnRenamed("conv_id", "found_id")
        rows = rows.join(named, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    return rows.select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts.columns if name != "conv_id"],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.sha2(F.lit(books.text()), 256).alias("codebooks_sha256"), "evaluated"
    )


def op13_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_pii_pseudonyms, op2_line_dedup, op3_language_id, op4_toxicity, op5_sentencepiece, op6_secret_scan,
    op7_simhash_groups, op8_decontamination, op9_warc_derivatives, op10_merkle_fingerprint,
    op11_conversation_repair, op12_vector_codes, op13_quality_outliers,
)}
