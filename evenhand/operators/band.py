"""Nearest partners within a distance band.

For every left row: the first ``k`` right rows with ``|right - left| < tol``, nearest first, ties by ``order``.
Joining all rows of neighbouring buckets and cutting afterwards would emit a quadratic number of pairs wherever
values crowd. Here

1. right rows become one row per value with its first ``k`` rows (no later one can be chosen),
2. both sides are range-partitioned together by value and then by a hash, so that a value that many left rows share
   is spread over several parts,
3. every part gets, as a halo, the ``k`` right values before its first row and the ``k`` after its last one, however
   many parts away they are,
4. within its part a left row looks at the ``k`` right values on either side of it.

Left rows move twice and are joined with nothing. No step emits more than a constant number of rows per input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.session import written

ROWS_PER_PART = 200_000


def nearest_in_band(
    left: DataFrame,
    right: DataFrame,
    on: str,
    order: Sequence[str],
    payload: Sequence[str],
    tol: float = 0.1,
    k: int = 5,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Left rows with an array column ``partners`` of at most ``k`` structs of ``on`` and ``payload``.

    Left rows without a partner are dropped. ``order`` names right columns and should make ties unique in all
    that is read from the partners. Parts hold about ``rows_per_part`` rows, and halos of at most 2 ``k``.
    """
    left, right = left.filter(F.col(on).isNotNull()), right.filter(F.col(on).isNotNull())
    fields = [on, *order, *[p for p in payload if p not in order and p != on]]
    first_k = right.select(*fields).withColumn("_rn", F.row_number().over(Window.partitionBy(on).orderBy(*order)))
    values = first_k.filter(F.col("_rn") <= k).groupBy(F.col(on).alias("_value")).agg(F.collect_list(F.struct(*fields)).alias("_rows"))
    asked = left.select(F.col(on).alias("_value"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"))
    both = asked.unionByName(values, allowMissingColumns=True)

    parts = -(-left.select(on).unionByName(right.select(on)).count() // rows_per_part)
    if parts > 1:
        # Equal rows of different input partitions part; a row that is computed anew has the same place again.
        place = F.xxhash64("_left", F.spark_partition_id())
        both = both.withColumn("_tie", place).repartitionByRange(parts, "_value", "_tie").drop("_tie")
        both = written(both.withColumn("_part", F.spark_partition_id()), "parts")
        both = both.unionByName(_halos(both, k), allowMissingColumns=True)
    else:
        both = both.withColumn("_part", F.lit(0))

    near = both.withColumn("_right", F.when(F.col("_rows").isNotNull(), F.struct("_rows")))
    window = "IGNORE NULLS OVER (PARTITION BY _part ORDER BY _value, _rows IS NULL)"
    sides = [F.expr(f"{side}(_right, {i}) {window}")["_rows"] for side in ("lag", "lead") for i in range(1, k + 1)]
    found = near.withColumns({f"_near{i}": rows for i, rows in enumerate(sides)}).filter(F.col("_left").isNotNull())
    candidates = F.flatten(F.array_compact(F.array(*[F.col(f"_near{i}") for i in range(2 * k)])))
    gaps = F.transform(candidates, lambda row: F.struct(F.abs(row[on] - F.col("_value")).alias("_gap"), row.alias("_row")))
    kept = F.slice(F.array_sort(F.filter(gaps, lambda row: row["_gap"] < tol)), 1, k)
    partners = F.transform(kept, lambda row: F.struct(*[row["_row"][c].alias(c) for c in [on, *[p for p in payload if p != on]]]))
    return found.withColumn("partners", partners).filter(F.size("partners") > 0).select("_left.*", "partners")


def _halos(both: DataFrame, k: int) -> DataFrame:
    """For every part the ``k`` right values before it and the ``k`` after it, as rows of that part.

    The windows over all parts have one task because they run over edges of parts, at most ``k + 1`` rows each.
    """
    rights = both.filter(F.col("_rows").isNotNull()).select("_part", "_value", "_rows")
    marks = both.select("_part").distinct()
    halos = None
    for ends, side, mark_first in ((F.desc("_value"), "lag", True), (F.asc("_value"), "lead", False)):
        edge = rights.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(ends))).filter(F.col("_rn") <= k)
        edge = edge.select("_part", F.lit(1 if mark_first else 0).alias("_at"), "_value", F.struct("_value", "_rows").alias("_edge"))
        marked = edge.unionByName(marks.withColumn("_at", F.lit(0 if mark_first else 1)), allowMissingColumns=True)
        window = "IGNORE NULLS OVER (PARTITION BY 0 ORDER BY _part, _at, _value)"
        seen = marked.select("_part", "_edge", *[F.expr(f"{side}(_edge, {i}) {window}").alias(f"_e{i}") for i in range(1, k + 1)])
        sent = seen.filter(F.col("_edge").isNull()).select("_part", F.inline(F.array_compact(F.array(*[f"_e{i}" for i in range(1, k + 1)]))))
        halos = sent if halos is None else halos.unionByName(sent)
    return halos
