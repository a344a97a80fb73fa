"""Two-sample tests between groups, from one aggregation over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.fixed_values import EFFECT_CUTS
from evenhand.functions import columns as C
from evenhand.functions.t_tail import two_sided


def compare_means(
    df: DataFrame,
    value: str,
    group: str,
    pairs: Sequence[tuple[str, str]] = (("low", "high"), ("low", "medium")),
    equal_var: bool = False,
    min_rows: int = 30,
) -> DataFrame:
    """t statistic, degrees of freedom and Cohen's d for pairs of groups; nulls are ignored.

    Welch's test by default, Student's pooled test with ``equal_var``. Moments of all groups come from one pass.
    """
    moments = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    return compare_moments(moments, group, pairs, equal_var, min_rows)


def compare_moments(
    moments: DataFrame,
    group: str,
    pairs: Sequence[tuple[str, str]] = (("low", "high"), ("low", "medium")),
    equal_var: bool = False,
    min_rows: int = 30,
) -> DataFrame:
    """The same from rows of ``group, n, m, v``: counts, means and sample variances of few groups.

    ``enough_rows`` says whether both groups have more than ``min_rows`` values; else the statistics are null.
    """
    names = sorted({g for pair in pairs for g in pair})
    wide = []
    for i, name in enumerate(names):
        here = F.col(group) == name
        wide += [F.max(F.when(here, F.col(k))).alias(f"{k}{i}") for k in "nmv"]
    rows = []
    for a, b in pairs:
        i, j = names.index(a), names.index(b)
        rows.append(
            F.struct(
                F.lit(f"{a}_vs_{b}").alias("test"),
                *[F.col(f"{k}{x}").alias(f"{k}_{side}") for x, side in ((i, "a"), (j, "b")) for k in "nmv"],
            )
        )
    sides = moments.agg(*wide).select(F.inline(F.array(*rows))).fillna(0, ["n_a", "n_b"])
    enough = (F.col("n_a") > min_rows) & (F.col("n_b") > min_rows)
    sides = sides.withColumn("enough_rows", enough)
    sides = sides.withColumns({v: F.when(enough, F.col(v)) for v in ("v_a", "v_b")})

    gap = F.col("m_a") - F.col("m_b")
    per_a, per_b = F.try_divide("v_a", "n_a"), F.try_divide("v_b", "n_b")
    if equal_var:
        freedom = (F.col("n_a") + F.col("n_b") - 2).cast("double")
        pooled = F.try_divide((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_b") - 1) * F.col("v_b"), freedom)
        one = F.lit(1.0)
        error = F.sqrt(pooled * (F.try_divide(one, "n_a") + F.try_divide(one, "n_b")))
    else:
        error = F.sqrt(per_a + per_b)
        freedom = F.try_divide(
            F.pow(per_a + per_b, F.lit(2.0)),
            F.try_divide(per_a * per_a, F.col("n_a") - 1) + F.try_divide(per_b * per_b, F.col("n_b") - 1),
        )
    spread = F.sqrt((F.col("v_a") + F.col("v_b")) / 2.0)
    return sides.select(
        "test",
        "n_a",
        "n_b",
        F.col("m_a").alias("mean_a"),
        F.col("m_b").alias("mean_b"),
        F.try_divide(gap, error).alias("t_stat"),
        F.when(F.col("enough_rows"), freedom).alias("df"),
        F.when(spread > 0, F.try_divide(gap, spread)).when(spread.isNotNull(), 0.0).alias("cohens_d"),
        "enough_rows",
    )


def with_effect(tests: DataFrame) -> DataFrame:
    return tests.withColumn("effect_size", C.effect_label(F.col("cohens_d"), EFFECT_CUTS))


def with_p_value(tests: DataFrame) -> DataFrame:
    """Two-sided p-value and the flags at 5 % and 0.1 %; runs on the few test rows."""
    p = F.col("p_value")
    return tests.withColumn("p_value", two_sided(F.col("t_stat"), F.col("df"))).withColumns(
        {"significant": p < 0.05, "highly_significant": p < 0.001}
    )
