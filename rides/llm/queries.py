"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rides.llm.common import prepare, scratch


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.packing import pack, packed_digest

    return packed_digest(pack(table(spark, sf, "documents")))


def op2_token_orc(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.token_orc import read_tokens, tokens_digest, write_tokens

    prepare(spark)
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path)
    return tokens_digest(read_tokens(spark, path))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.quality_rules import judge, judged_digest

    return judged_digest(judge(table(spark, sf, "documents")))


def op4_minhash(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf, "documents"), words=4)


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.decontamination import contamination, contamination_digest

    return contamination_digest(contamination(table(spark, sf, "documents"),
                                              table(spark, sf, "benchmark")))


# A conversation whose texts hold control strings, added by the contract.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op6_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.lm_score import lm_scores

    return lm_scores(table(spark, sf, "documents"))


def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.chat_format import format_digest, windows

    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).selectExpr(
        "-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role").withColumn(
            "text", F.lit(CONTROL_TEXT))
    return format_digest(windows(turns.unionByName(extra)))


# Explicit verdicts by host and start of path; the longest that fits holds.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.url_filter import judge

    return judge(table(spark, sf, "pages"), URL_RULES)


def op9_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.suffix_array import cut, cut_digest

    return cut_digest(cut(table(spark, sf, "documents")))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.sharding import write_shards

    prepare(spark)
    rows = write_shards(table(spark, sf, "documents"), scratch(spark, "shards"))
    return rows.select("doc_id", "shard", "part",
                       F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))


def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.merkle import build_manifest, document_leaves, proofs, proofs_digest

    prepare(spark)
    leaves = document_leaves(table(spark, sf, "documents"))
    return proofs_digest(proofs(build_manifest(leaves, "lang", "doc_id")))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.periodic_runs import periodic_runs, planted, runs_digest

    return runs_digest(periodic_runs(planted(table(spark, sf, "documents"))))


def op13_bit_sliced(spark: SparkSession, sf: str) -> DataFrame:
    from rides.llm.bit_sliced import top_k

    prepare(spark)
    return top_k(table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_orc": op2_token_orc,
    "op3_quality_rules": op3_quality_rules,
    "op4_minhash": op4_minhash,
    "op5_decontamination": op5_decontamination,
    "op6_lm_score": op6_lm_score,
    "op7_chat_format": op7_chat_format,
    "op8_url_filter": op8_url_filter,
    "op9_suffix_array": op9_suffix_array,
    "op10_sharding": op10_sharding,
    "op11_merkle": op11_merkle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_bit_sliced": op13_bit_sliced,
}
