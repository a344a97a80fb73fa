"""Exact quantiles and numeric summaries without gathering a column in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.session import written


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows of ``column, n, prob, value`` with linear interpolation between neighbouring ranks; nulls ignored.

    The input is read once, to count the rows of every distinct value. The counts are range-partitioned by column and
    value; sums of the parts before and a running sum inside each part give every value its ranks. No part depends on
    how many rows a value has, and no window sees more than a part.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    counted = df.select(cells).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    parted = counted.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
    parted = written(parted, "value-counts")  # a part number holds only once it is written

    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("column")  # one row per column and part
    parts = parted.groupBy("column", "part").agg(F.sum("rows").alias("in_part")).select(
        "column", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"), F.sum("in_part").over(everything).alias("n")
    )
    inside = Window.partitionBy("column", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = parted.withColumn("last", F.sum("rows").over(inside)).join(parts, ["column", "part"])
    first, last = F.col("before") + F.col("last") - F.col("rows"), F.col("before") + F.col("last")

    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    place = F.col("prob") * (F.col("n") - 1)
    hit = ranked.select("column", "n", "value", first.alias("first"), last.alias("last"), wanted)
    low, high = F.floor(place), F.ceil(place)
    holds_low, holds_high = ((F.col("first") <= k) & (k < F.col("last")) for k in (low, high))
    ends = hit.filter(holds_low | holds_high).groupBy("column", "n", "prob").agg(
        F.max(F.when(holds_low, F.col("value"))).alias("low"), F.max(F.when(holds_high, F.col("value"))).alias("high")
    )
    return ends.select("column", "n", "prob", (F.col("low") + (F.col("high") - F.col("low")) * (place - low)).alias("value"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum: one row per column, one pass."""
    stats = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(c).alias(f"{c}__{n}") for c in columns for n, f in stats.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n in stats]) for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))
