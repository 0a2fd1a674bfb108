"""All queries of the engine with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from xmarket.plans import q_book, q_decisions, q_envelopes, q_more, q_pairs, q_sync, q_text  # noqa: F401
from xmarket.plans.registry import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities over all pairs of books, both directions."""
    return q_book.s11_opportunities(spark, sf_dir)
