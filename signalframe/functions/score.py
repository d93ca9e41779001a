"""Per-article score, context flags and forecast errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions.text import as_column, contains_any


def impact_score(
    avg_amount: str | Column = "avg_amount",
    amount_count: str | Column = "amount_count",
    entity_count: str | Column = "entity_count",
    energy: str | Column = "theme_Energy",
    infrastructure: str | Column = "theme_Infrastructure",
    environment: str | Column = "theme_Environment",
    negative: str | Column = "tone_negative",
) -> Column:
    """Composite impact, at most 100; NULL where the logarithm is undefined."""
    amount, entities = as_column(avg_amount), as_column(entity_count)
    tone, is_energy = as_column(negative), as_column(energy) > 0
    size = (
        F.when(as_column(amount_count) > 0, 1 + F.log1p(F.least(amount, F.lit(10000.0))))
        .when(entities > 0, 1 + F.log1p(F.least(entities.cast("double"), F.lit(1000.0))))
        .otherwise(F.lit(1.0))
    )
    score = (
        size
        * F.when(is_energy, 2.0).otherwise(1.0)
        * F.when(as_column(infrastructure) > 0, 1.5).otherwise(1.0)
        * F.when(as_column(environment) > 0, 1.3).otherwise(1.0)
        * F.when(is_energy & (tone > 0), 1 + tone * 0.5).otherwise(1.0)
    )
    return F.when(score.isNotNull(), F.least(score, F.lit(100.0)))


def context_flags(themes: str | Column, parity: bool = True) -> dict[str, Column]:
    """Eight 0/1 context flags over an array of lower-case theme names.

    ``parity=True`` sets supply and demand only, the other six stay 0.
    """
    themes = as_column(themes)
    flags = {}
    for name, words in config.CONTEXT_KEYWORDS.items():
        if parity and name not in config.PARITY_CONTEXTS:
            flags[name] = F.lit(0)
        else:
            flags[name] = F.coalesce(mentions_any(themes, words), F.lit(False)).cast("int")
    return flags


def mentions_any(themes: Column, words: list[str]) -> Column:
    return F.exists(themes, lambda t: contains_any(t, words))


def error_columns(actual: str | Column = "actual", predicted: str | Column = "predicted") -> dict[str, Column]:
    """Error, absolute error and percent error (NULL where the actual is 0)."""
    actual = as_column(actual)
    error = actual - as_column(predicted)
    return {"error": error, "abs_error": F.abs(error),
            "percent_error": F.try_divide(error, actual) * 100}
