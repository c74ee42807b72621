"""The registered queries of this subpackage, and their SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm import chat, collocations, html_extract, kdtree, license_scan, mixing, near_dup, ngram_rules, packing, quality, sharding, toxicity
from residua.session import table

TOKENIZER = "byte_bpe_50k.json"
#: Loss-bearing tokens of a sequence of instruction data, at most.
MAX_LOSS = 1536


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), max_sources=None)


#: Target weights of weighted_mixing: uneven, and one of them far under a thousandth.
WEIGHTS = {"src0": 0.2995, "src1": 0.0005, "src2": 0.15, "src3": 0.1} | {f"src{k}": 0.028125 for k in range(4, 20)}
BLOCK_CHARS = 1 << 12


def weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents mixed to target weights, in small blocks."""
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, BLOCK_CHARS, max_sources=None)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assistant's turns, each led by the turn before, under limits on tokens, segments and loss.

    An example's doc_id is its conversation's id times 2 to the 20th and its turn.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    before = rows.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("lead")).hint("merge")
    examples = rows.filter(F.col("role") == "assistant").join(before, ["conv_id", "turn"], "left")
    number = F.col("conv_id").cast("long") * (1 << 20) + F.col("turn")
    examples = examples.select(number.alias("doc_id"), "text", "lead")
    return packing.pack_documents(examples, public_tokenizers.path(TOKENIZER), max_loss=MAX_LOSS, prompt="lead")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_probe(table(spark, sf_dir, "conversations")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_source_mixing": op2_source_mixing,
        "op3_html_extraction": op3_html_extraction,
        "op4_toxicity": op4_toxicity,
        "op5_ngram_rules": op5_ngram_rules,
        "op6_exact_top_k": op6_exact_top_k,
        "op7_packing": op7_packing,
        "instruction_packing": instruction_packing,
        "weighted_mixing": weighted_mixing,
        "op8_license_scan": op8_license_scan,
        "op9_chat_format": op9_chat_format,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_collocations": op11_collocations,
        "op12_sharding": op12_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": mixing.oracle_sql(),
        "weighted_mixing": mixing.oracle_sql(BLOCK_CHARS, WEIGHTS),
        "op6_exact_top_k": kdtree.oracle_sql(),
        "op8_license_scan": license_scan.oracle_sql(),
        "op9_chat_format": chat.oracle_sql(),
        "op10_near_duplicates": near_dup.oracle_sql(words=3, percent=85),
        "op11_collocations": collocations.oracle_sql(),
        "op12_sharding": sharding.oracle_sql(),
    }
