"""Projection of a measured overcharge to a yearly volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.fixed_values import ANNUAL_TRIPS, RUPEES_PER_DOLLAR


def _scale(annual: float, sample_part: float) -> Column:
    """Yearly trips per row. ``sample_part`` is the share of the sample the rows are, 0.2 for a test split."""
    return F.lit(float(annual)) / (F.col("rows") / F.lit(sample_part))


def total(
    df: DataFrame,
    error: str = "baseline_error",
    group: str = "income_category",
    member: str = "low",
    annual: float = ANNUAL_TRIPS,
    sample_part: float = 1.0,
) -> DataFrame:
    """Mean overcharge of one group, its yearly trips and their product, from one pass.

    With ``sample_part`` below 1 the rows stand for a larger sample, so each weighs that much less.
    """
    in_group = F.col(group) == member
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(in_group).alias("group_rows"),
        F.avg(F.when(in_group, F.col(error))).alias("avg_overcharge"),
    )
    return projected(sums, annual, sample_part)


def projected(sums: DataFrame, annual: float = ANNUAL_TRIPS, sample_part: float = 1.0) -> DataFrame:
    """Yearly figures from ``rows``, ``group_rows`` and ``avg_overcharge``."""
    trips = F.col("group_rows") * _scale(annual, sample_part)
    impact = trips * F.col("avg_overcharge")
    return sums.select(
        "rows",
        "group_rows",
        F.try_divide(F.col("group_rows") * 100.0, F.col("rows")).alias("group_share_pct"),
        "avg_overcharge",
        trips.alias("annual_trips"),
        impact.alias("annual_impact_usd"),
        (impact * RUPEES_PER_DOLLAR).alias("annual_impact_inr"),
    )


def by_place(
    df: DataFrame,
    place: str = "borough",
    error: str = "baseline_error",
    group: str = "income_category",
    member: str = "low",
    annual: float = ANNUAL_TRIPS,
) -> DataFrame:
    """Yearly impact on one group by place; the scale counts all rows, those without a place included."""
    in_group = F.col(group) == member
    places = df.groupBy(place).agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(in_group).alias("group_rows"),
        F.sum(F.when(in_group, F.col(error))).alias("group_error"),
    )
    everything = Window.partitionBy(F.lit(0))  # over place rows only
    rows = places.withColumn("rows", F.sum("all_rows").over(everything)).filter(
        F.col(place).isNotNull() & (F.col("group_rows") > 0)
    )
    return rows.select(
        place, "group_rows", (F.col("group_error") * _scale(annual, 1.0)).alias("annual_impact_usd")
    ).orderBy(place)
