"""Ordered reports. Ties are broken by further columns so that every run lists the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.functions import columns as C


def top(df: DataFrame, by: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows; planned as a top-n, not as a sort."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def worst_places(df: DataFrame, prediction: str, label: str, places: Sequence[str], n: int = 10) -> DataFrame:
    """Places with the highest mean overcharge in dollars."""
    table = df.groupBy(*places).agg(
        F.count(F.lit(1)).alias("trips"),
        C.steady_round(F.avg(F.col(prediction) - F.col(label)), 2).alias("avg_overcharge"),
    )
    return top(table, "avg_overcharge", n, places)
