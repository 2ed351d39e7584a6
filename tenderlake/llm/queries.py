"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import bpe, decontaminate, divergence, licenses, lines, packing, sharding, simhash, sql, tokenfiles, topk, toxicity, treap, warc, wordbpe
from tenderlake.llm.common import table
from tenderlake.storage import tuned


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.labelled(table(tuned(spark), sf_dir, "documents"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(tuned(spark), sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(tuned(spark), sf_dir, "embeddings")
    return topk.search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(tuned(spark), sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(tuned(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(tuned(spark), sf_dir, "documents"), wordbpe.vocabulary_path())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(tuned(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(warc.round_trip(table(tuned(spark), sf_dir, "pages")))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(tuned(spark), sf_dir, "documents"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(tuned(spark), sf_dir, "documents"), wordbpe.vocabulary_path())


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(table(tuned(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(tuned(spark), sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(tuned(spark), sf_dir, "documents"), wordbpe.vocabulary_path())


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_lines": op2_lines,
    "op3_topk": op3_topk,
    "op4_simhash": op4_simhash,
    "op5_decontamination": op5_decontamination,
    "op6_bpe": op6_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_shards": op9_shards,
    "op10_tokens": op10_tokens,
    "op11_lexical": op11_lexical,
    "op12_divergence": op12_divergence,
    "op13_packing": op13_packing,
}
SQL = {"op1_licenses": sql.LICENSES, "op3_topk": sql.TOPK, "op5_decontamination": sql.DECONTAMINATION, "op8_warc": sql.WARC, "op9_shards": sql.SHARDING, "op11_lexical": sql.LEXICAL, "op12_divergence": sql.DIVERGENCE}
