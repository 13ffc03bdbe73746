"""Documents to a training mix: quality, line dedup, near duplicates, benchmark leaks, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.decontaminate import decontaminate
from sluiceway.llm.line_dedup import dedup_lines
from sluiceway.llm.mixing import mix
from sluiceway.llm.ngram_join import one_of_each
from sluiceway.llm.quality import score_quality
from sluiceway.llm.staging import release, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept.

    Texts that are null, empty or very long are scored like others; repeated rows are scored alike. No rows: no rows.
    """
    release(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).where("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand elsewhere; every document stays."""
    release(spark)
    found = dedup_lines(docs)
    changed = F.when(F.col("lines_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five words and a similarity of 0.8: the one with the smallest id."""
    release(spark)
    return one_of_each(docs, 5, 80).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null, empty and blank texts and items hold nothing and are held by nothing; repeated rows go or stay together. No rows: no rows.
    """
    release(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def weigh_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes.

    Null text: no words. A null source is a source. Rows alike in id and text are taken together. No rows: no rows.
    """
    release(spark)
    return mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", weigh_sources),
]

#: The classifier is fitted, which SQL cannot express; line dedup and the n-gram join are compared with plain programs instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
