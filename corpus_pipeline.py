"""The corpus pipeline: stages over `documents`, each written as Parquet and read again.

Every stage takes all that the one before it kept, and all but the last return
the columns of the documents. Null keys, texts and sources, empty tables, repeated
rows and further columns are handled as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import byte_bpe, line_dedup, mixing, near_dup, quality_rules
from tallybrook.plans.tables import Query, table
from tallybrook.session import run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the rules learned from `labels` reject."""
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.kept(docs, rules)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of three or more lines that occur before."""
    rows = line_dedup.without_repeats(docs, counts=False)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles and 0.8."""
    return near_dup.without_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with files that hold them in an order that mixes the sources to their weights."""
    return mixing.in_mixed_order(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with packed token ids, their number, and whether they decode to the text.

    Files that are read again come in any order, so the mix, which follows from the
    documents, is worked out again; the texts are coded in that order.
    """
    docs = mixing.in_mixed_order(docs)
    ranks = byte_bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return coded.withColumns({"n_tokens": n_tokens, "round_trip": same}).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_dup_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", byte_bpe_stage),
]

# The learned rules of the first stage cannot be said in SQL; tests hold the whole run
# against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, in order; the result is sorted into the mix.

    `mixing.mixed` gives the rows of the result their slots and positions as columns.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return mixing.in_mixed_order(docs)


QUERY = Query(run, ORACLE_SQL)
