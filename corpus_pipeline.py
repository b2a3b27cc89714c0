"""The corpus pipeline: classify, clean lines, drop near copies, mix sources, pack sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result to
the shared scratch folder and hands the files to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import lines, mixing, packing, quality, simhash
from ferry.llm.common import landed, read
from ferry.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (one row of it)."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the source schedule."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes; shards are contiguous runs of the source schedule.

    The order of rows does not survive writing and reading, so the slots, which
    depend on the rows alone, are worked out again.
    """
    return packing.packed(mixing.scheduled(docs), schedule=("_slot", "_offset"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# A trained classifier and fingerprints by XXH64 are not SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
