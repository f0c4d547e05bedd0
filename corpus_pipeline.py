"""A training corpus from raw documents: quality, boilerplate, near duplicates, benchmark leaks, source mix."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from jobgauge.sources.scratch import written

#: Words of a shingle, and the least similarity in percent, of near copies; the op5 query has values of its own.
SHINGLE_WORDS = 5
PERCENT = 80


#: Columns that stages read or write; all others pass through.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that cannot mistake the caller's other columns for its own: they have plain names while it runs."""

    @functools.wraps(stage)
    def run_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = {name: f"extra{i}" for i, name in enumerate(docs.columns) if name not in READ}
        out = stage(spark, docs.toDF(*[plain.get(name, name) for name in docs.columns]), sf_dir)
        return out.toDF(*docs.columns)

    return run_apart


@_apart
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier scores below 0.5. Labels come from the labels table.

    A NULL or empty text is scored by the bias alone. An empty table, or labels of one kind only, drop nothing but
    what that kind says, see `quality.train_ftrl`.
    """
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model).filter("_score >= 0.5").select(*docs.columns)


@_apart
def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many sources share from all but their first document, and drop documents left without any text.

    Documents that were blank before stay. n_chars follows the text.
    """
    cut = line_dedup.dedup_lines(docs).withColumn("_cut", F.size("_removed") > 0)
    kept = cut.filter(~F.col("_cut") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _with_length(kept, "_cut").select(*docs.columns)


@_apart
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest doc_id; see `jaccard_join.keep_first`.

    NULL, empty and blank texts all stay; of repeated rows one stays; an empty table stays empty.
    """
    return jaccard_join.keep_first(docs, jaccard_join.link_documents(docs, shingle_words=SHINGLE_WORDS, percent=PERCENT))


@_apart
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages, and drop documents that consist of them for the most part. n_chars follows the text.

    NULL and empty texts stay as they are, repeated rows are treated alike, an empty table or benchmark drops nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cut = decontaminate.decontaminate(docs.withColumn("_before", F.xxhash64("text")), benchmark)
    return _with_length(cut.withColumn("_cut", F.xxhash64("text") != F.col("_before")), "_cut").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan of the mix: doc_id, source, size, source_size, target and taken, the words to take of each document.

    NULL and empty texts have size 0 and are never taken, repeated rows are documents of their own, other columns are left
    out, an empty table gives an empty one.
    """
    return mixing.mix(docs)


def _with_length(docs: DataFrame, changed: str) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    length = F.char_length("text").cast(kind)
    return docs.withColumn("n_chars", F.when(F.col(changed), length).otherwise(F.col("n_chars")))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
]

#: The classifier of the first stage cannot be written in SQL; tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written out before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
