"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources import tables as TB
from . import oracle
from . import (fill_middle, language_id, lexical_search, mixing, near_dedup, packing, quality_classifier, quality_rules, secrets, sentence_pieces,
               toxicity, url_reputation, vp_search)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return TB.table(spark, sf_dir, name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 1024, cut by dynamic programming."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every hundredth vector."""
    return vp_search.report(_table(spark, sf_dir, "embeddings"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and reputation verdict of every page url."""
    return url_reputation.judge(_table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.report(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the adaptive quality rules for every document."""
    return quality_rules.report(_table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dedup.groups(_table(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, those in nested encodings included."""
    return secrets.report(_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle cuts and output of every document."""
    return fill_middle.report(_table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text decoded from them."""
    return sentence_pieces.report(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best documents of every benchmark item by the words they share."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_classifier, op2_language_id, op3_toxicity, op4_packing, op5_vp_search, op6_url_filters, op7_mixing, op8_quality_rules, op9_near_dedup, op10_secret_scans,
                                       op11_fill_middle, op12_sentence_pieces, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
