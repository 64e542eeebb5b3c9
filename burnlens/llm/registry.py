"""Queries of the corpus operators: ``name -> (spark, sf_dir) -> DataFrame``,
each over its whole tables, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from burnlens.llm import collocations, decontaminate, lm, packing, pii, polytope, quality, simhash, tokencount, topk, toxicity, treap, warc
from burnlens.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    return pii.query(table(spark, sf_dir, "documents"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-frequency and context-mixing scores of every text of ``documents``."""
    return lm.query(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` by SimHash."""
    return simhash.query(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best partners in ``embeddings`` of every hundredth vector."""
    return topk.query(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC archives and read back."""
    return warc.query(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every text of ``documents``."""
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every text of ``documents``."""
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text of ``documents``."""
    return tokencount.query(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training sequences of 4,096 tokens from ``documents``."""
    return packing.query(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of ``documents`` that match an item of ``benchmark``."""
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of ``embeddings``."""
    return polytope.query(table(spark, sf_dir, "embeddings"))


def op12_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every item of ``benchmark``."""
    return treap.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of up to four words in each language of ``documents``."""
    return collocations.query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_lm": op2_lm,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_tokencount": op8_tokencount,
    "op9_packing": op9_packing,
    "op10_decontaminate": op10_decontaminate,
    "op11_polytope": op11_polytope,
    "op12_treap": op12_treap,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op4_topk": topk.SQL,
    "op5_warc": warc.SQL,
    "op11_polytope": polytope.SQL,
    "op12_treap": treap.SQL,
    "op13_collocations": collocations.SQL,
}
