"""The corpus pipeline: five stages of the training-data operators over documents.

Every stage but the last returns the columns of documents; the last returns the packed
pieces. ``run`` writes each stage as Parquet in the shared folder and reads it again, so
a lost executor costs the stage at hand only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from clipforge.llm.common import stored
from clipforge.sources.tables import table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or diverge from their language go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: boilerplate lines of each source leave the texts; every document stays."""
    out = line_dedup.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five-word shingles at 80 %: one document of each group stays."""
    return jaccard_join.keep_one(docs, percent=80, shingle=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak an item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left: one row per piece."""
    return packing.pack(docs)


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("jaccard_join", near_copies), ("decontamination", benchmark), ("packing", pack)]

#: Tokenising and packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
