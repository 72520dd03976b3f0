"""From raw documents to token digests: toxicity, line dedup, near-duplicates, decontamination, byte-level BPE.

Each stage takes what the one before kept, written as Parquet in the shared folder and read again, so a lost executor
costs part of one stage. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlytics.llm import toxicity
from streamlytics.llm.bpe import round_trip
from streamlytics.llm.catalog import TOXIC_FROM, tokenizer
from streamlytics.llm.decontaminate import contamination, is_contaminated
from streamlytics.llm.line_dedup import drop_boilerplate
from streamlytics.llm.minhash import near_duplicates
from streamlytics.llm.registry import prepared, table
from streamlytics.session import materialize

PERCENT = 80  # of their shingles that near-duplicates share
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(prepared(spark), docs.select(*COLUMNS), sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the network, trained on the labelled ones among them, scores as toxic."""
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, scorer).filter(F.col("score") < TOXIC_FROM).select(*COLUMNS)


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source."""
    cleaned = drop_boilerplate(docs).withColumn("n_chars", F.when(
        F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return cleaned.select(*COLUMNS)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest id. Of rows that share an id one stays; rows without an id
    are in no group and stay."""
    kept = near_duplicates(docs, percent=PERCENT).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text", "lang", "source", "n_chars")
    named = named.withColumn("__place", F.row_number().over(order)).filter("__place = 1")
    return named.select(*COLUMNS).union(docs.filter("doc_id IS NULL").select(*COLUMNS))


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which a twentieth lies in passages of the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = materialize(found.filter(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(
        "doc_id", "text_hash").distinct(), "contaminated")
    return docs.withColumn("text_hash", F.xxhash64("text")).alias("d").join(
        bad.alias("b"), F.expr("d.doc_id <=> b.doc_id AND d.text_hash = b.text_hash"), "left_anti").select(*COLUMNS)


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of each document."""
    return round_trip(docs, *tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]

# A trained network, shingle sets of all texts and token merges are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of all documents that come through."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
