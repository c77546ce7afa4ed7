"""One query per operator over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, metric_search, mixing, quality_rules, sharding, token_alignment, toxicity
from tidemark.llm.collocations import best_phrases, count_phrases
from tidemark.llm.decontamination import find_leaks
from tidemark.llm.jaccard_join import similar_groups
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.line_dedup import drop_common_lines
from tidemark.llm.shared import held_out, read_table
from tidemark.llm.substring_dedup import remove_repeats


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = remove_repeats(read_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_licenses(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda s: s["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct("spans.label")), ",").alias("labels"),
        F.coalesce(F.array_max("spans.score"), F.lit(0.0)).alias("score"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", mixing.word_count().alias("size"), mixing.draw().alias("chance"))
    targets = mixing.with_targets(mixing.cyclic_weights(mixing.source_sizes(docs), [5, 2, 1]))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.planned(docs, targets, F.col("chance")).select("doc_id", "size", "source_size", "target", taken)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    rows = toxicity.scored(docs, model, keep=["doc_id"])
    return rows.select("doc_id", held_out().alias("held_out"), "score", predicted, "n_sentences", "offending")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_common_lines(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(read_table(spark, sf_dir, "documents"))
    body = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = language_id.predicted(docs, language_id.train(docs))
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "family")


def op9_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = metric_search.scaled(read_table(spark, sf_dir, "embeddings"))
    return metric_search.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = best_phrases(count_phrases(read_table(spark, sf_dir, "documents")))
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.linked(token_alignment.align(read_table(spark, sf_dir, "documents")))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.learn(docs, read_table(spark, sf_dir, "labels")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_license_scan,
        op3_decontamination,
        op4_mixing,
        op5_toxicity,
        op6_line_dedup,
        op7_sharding,
        op8_language_id,
        op9_metric_search,
        op10_jaccard_join,
        op11_phrase_collocations,
        op12_token_alignment,
        op13_quality_rules,
    )
}
