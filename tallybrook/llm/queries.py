"""The queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import (
    byte_bpe,
    language_id,
    lattice_lm,
    lexical_scan,
    line_dedup,
    mixing,
    near_dup,
    prefix_forest,
    quality_rules,
    sharding,
    spelling,
    url_filter,
    wrappers,
)
from tallybrook.plans.tables import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text, and the verdict of base rules and learned rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judged(docs, rules)
    counts = [F.col("stats")[name].alias(name) for name in quality_rules.COUNTS]
    return judged.select("row.doc_id", *counts, "base_failed", "kept", "rule")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from three folds of four."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = language_id.fold(F.col("doc_id"), 4)
    model = language_id.fit(docs.where(fold != 2))
    found = language_id.predicted(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(language_id.fold(F.col("row.doc_id"), 4) == 2, F.lit(False))
    return found.select(
        "row.doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every url; a page is bad where its document is labelled so.

    The number in a page's path is the id of the document it was made from.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    known = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    path = url_filter.with_host_and_path(pages).select("row.*", "path")
    doc_id = F.regexp_extract("path", "/([0-9]+)", 1).try_cast("bigint")
    labelled = path.select("page_id", "url", doc_id.alias("doc_id")).join(known, "doc_id", "left")
    judged = url_filter.judged(labelled.select("page_id", "url", "bad"))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document, by four-word shingles and a similarity of 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs, width=4)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and digests of the ids and of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = byte_bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of three or more lines that occur before."""
    return line_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text, learned from six folds of seven."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = lattice_lm.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    scored = lattice_lm.scored(docs, pieces, language_id.fold(F.col("doc_id"), 7) != 2)
    held_out = F.coalesce(language_id.fold(F.col("doc_id"), 7) == 2, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "lattice_score"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place in it, equal texts kept together."""
    placed = sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, by inner product."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return prefix_forest.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, slot and position in the mix of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the texts, the words one edit away, and the common form it may stand for."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(docs))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by its host's wrapper."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.main_texts(pages).select("page_id", "url", "text", "n_chars")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_scan.ranked(docs, table(spark, sf_dir, "benchmark"))
