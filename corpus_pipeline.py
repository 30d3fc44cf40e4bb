"""The corpus pipeline: five stages of the training-data operators over `documents`.

Each stage reads all that the one before kept and returns the columns of `documents`; the last adds the
places in the mixture. Stages are written and read again, so that lost executors cost one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import decontaminate, language, line_dedup, mixing, near_dup
from tillwright.llm.shipping import ship
from tillwright.session import tune, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(run: Stage) -> Stage:
    """The session's adaptive settings hold for every stage, also one that is run alone."""

    @wraps(run)
    def tuned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return run(tune(ship(spark)), docs, sf_dir)

    return tuned


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text in one of the languages go; `lang` becomes the language that was found."""
    keyed = _keyed(docs)
    found = language.identify(keyed, language.train(docs), "_key", "text", declared="lang", host="source")
    found = found.where("keep").select("id.*", "language").dropDuplicates(["_k0", "_k1"])
    return keyed.drop("_key").join(written(found, "languages"), ["_k0", "_k1"]).withColumn("lang", F.col("language")).select(COLUMNS)


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each line found in ten documents or more, only the first occurrence stays."""
    kept = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1, keep="first")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dup.one_per_class(docs).select(COLUMNS)


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with an item of the benchmark go."""
    keyed = _keyed(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(keyed, items, doc_id="_key").where("n_hit > 0").select("doc_id.*").distinct()
    return keyed.drop("_key").join(written(found, "contaminated"), ["_k0", "_k1"], "left_anti").select(COLUMNS)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their places in a mixture where a source weighs the square root of its size."""
    return mixing.mix(docs.select(COLUMNS), "source", order=["doc_id"])


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with 128 bits that stand for their id and text; equal ones share every decision."""
    keys = [F.xxhash64(F.lit(salt), "doc_id", F.col("text").isNull(), "text").alias(f"_k{salt}") for salt in range(2)]
    return docs.select("*", *keys).withColumn("_key", F.struct("_k0", "_k1"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
