"""Fees, token prices and shares of usage as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEE_RATE = 0.07  # fixed value: the K venue's taker fee is 0.07 * p * (1 - p)


def venue_fee(price: Column) -> Column:
    """X49."""
    return F.lit(FEE_RATE) * price * (F.lit(1.0) - price)


def estimated_tokens(text: Column, chars_per_token: float = 4.0) -> Column:
    """A lower (4.0) or upper (3.5 characters a token) bound on the tokens of a text."""
    return F.greatest(F.lit(1), F.ceil(F.length(text) / F.lit(chars_per_token))).cast("long")


def uncached(input_tokens: Column, cached_tokens: Column) -> Column:
    return F.greatest(F.lit(0), input_tokens - cached_tokens)


def usage_cost(input_tokens: Column, cached_tokens: Column, output_tokens: Column, input_rate: Column, cached_rate: Column, output_rate: Column) -> Column:
    """USD, rates per million tokens."""
    return (uncached(input_tokens, cached_tokens) * input_rate + F.least(cached_tokens, input_tokens) * cached_rate + output_tokens * output_rate) / F.lit(1_000_000.0)


def with_rates(usage: DataFrame, prices: DataFrame, model_col: str = "model") -> DataFrame:
    """Attach the price of the longest model prefix; prices(prefix, input, cached_input, output) is a small dimension.

    Models without a price keep null rates.  The lookup runs once per distinct model, then joins back.
    """
    models = usage.select(F.col(model_col).alias("__model")).distinct()
    hits = models.join(prices, F.col("__model").startswith(F.col("prefix")))
    best = hits.groupBy("__model").agg(F.max_by(F.struct("input", "cached_input", "output"), F.length("prefix")).alias("rate"))
    return usage.join(best, F.col(model_col) == F.col("__model"), "left").drop("__model").select("*", "rate.*").drop("rate")


def usage_share(total: Column, n: Column, place: Column) -> Column:
    """The integer share of a place (from 0) among n: the remainder goes to the first."""
    return F.floor(total / n).cast("long") + F.when(place < F.pmod(total, n), F.lit(1)).otherwise(F.lit(0))
