"""The corpus pipeline: stages that each apply one operator of ``rides.llm``
to the documents that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rides.llm import decontamination, minhash, packing, quality_rules, suffix_array
from rides.llm.common import prepare, saved

# The last stage's token ids come from a tokenizer, which SQL cannot run.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, with the smallest id, of each group of near duplicates, rows
    without an id included: five-word shingles, similarity 0.8."""
    return minhash.deduplicated(docs, judge_null_ids=True)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur elsewhere too; every
    document stays, one of only such strings with an empty text."""
    return suffix_array.without_repeats(docs).withColumn(
        "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 4096 tokens."""
    return packing.packed_digest(packing.pack(docs))


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("suffix array", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and
    read again as the next stage's documents."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
