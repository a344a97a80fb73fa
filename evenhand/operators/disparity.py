"""Group tables that set predictions against actual values.

Each table is one aggregation over the input for all models together; only group rows leave it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.fixed_values import INCOME_ORDER
from evenhand.functions import columns as C

LABEL = "fare_amount"
DISTANCE = "trip_distance"
INCOME = "median_income"


def with_errors(df: DataFrame, label: str, models: Mapping[str, str]) -> DataFrame:
    """Signed and absolute error of every model."""
    added = {}
    for name, prediction in models.items():
        error = F.col(prediction) - F.col(label)
        added[f"{name}_error"] = error
        added[f"{name}_abs_error"] = F.abs(error)
    return df.withColumns(added)


def mean(name: str, digits: int = 2) -> Column:
    return C.steady_round(F.avg(name), digits)


def excess(prediction: str, label: str = LABEL, digits: int = 1) -> Column:
    """Percent by which the mean prediction exceeds the mean actual value, from exact means, rounded last."""
    return C.steady_round(C.overcharge_pct(F.avg(prediction), F.avg(label)), digits)


def near_distance(df: DataFrame, target: float = 5.0, tolerance: float = 0.5, column: str = DISTANCE) -> DataFrame:
    """Rows of comparable distance; both ends of the band belong to it."""
    return df.filter(F.col(column).between(target - tolerance, target + tolerance))


def profile(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], count_as: str = "trip_count") -> DataFrame:
    """Row count and measures per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_as), *[m.alias(n) for n, m in measures.items()])


def bias_table(df: DataFrame, by: str, models: Mapping[str, str], label: str = LABEL) -> DataFrame:
    """Rows of ``model, group`` with count, mean distance, actual, prediction, error and overcharge."""
    shared = {"avg_distance": mean(DISTANCE), "avg_actual": mean(label)}
    per_model = {}
    for name, prediction in models.items():
        per_model[f"{name}_p"] = mean(prediction)
        per_model[f"{name}_e"] = C.steady_round(F.avg(F.col(prediction) - F.col(label)), 2)
        per_model[f"{name}_o"] = excess(prediction, label)
    wide = profile(df, [by], shared | per_model)
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"{name}_p").alias("avg_predicted"),
            F.col(f"{name}_e").alias("avg_error"),
            F.col(f"{name}_o").alias("overcharge_pct"),
        )
        for name in models
    ]
    return wide.select(by, "trip_count", *shared, F.inline(F.array(*rows))).select(
        "model", by, "trip_count", *shared, "avg_predicted", "avg_error", "overcharge_pct"
    )


def controlled_table(df: DataFrame, by: str, models: Mapping[str, str], target=5.0, tolerance=0.5) -> DataFrame:
    """Prediction and overcharge of every model among trips of comparable distance."""
    measures = {"avg_dist": mean(DISTANCE), "actual": mean(LABEL)}
    measures |= {f"{n}_pred": mean(p) for n, p in models.items()}
    measures |= {f"{n}_oc_pct": excess(p) for n, p in models.items()}
    return profile(near_distance(df, target, tolerance), [by], measures, "trips")


def place_table(df: DataFrame, by: str, prediction: str) -> DataFrame:
    """Overcharge of one model by place, least overcharged first."""
    measures = {
        "avg_income": mean(INCOME, 0),
        "avg_actual": mean(LABEL),
        "baseline_pred": mean(prediction),
        "overcharge_pct": excess(prediction),
    }
    return profile(df, [by], measures, "trips").orderBy("overcharge_pct", by)


def summary_by_income(df: DataFrame, models: Mapping[str, str], by: str = "income_category") -> DataFrame:
    """The wide summary that is stored for later reports."""
    measures = {"avg_distance": mean(DISTANCE), "avg_actual_fare": mean(LABEL)}
    measures |= {f"{n}_predicted": mean(p) for n, p in models.items()}
    measures |= {f"{n}_avg_error": C.steady_round(F.avg(F.col(p) - F.col(LABEL)), 2) for n, p in models.items()}
    measures |= {f"{n}_overcharge_pct": excess(p) for n, p in models.items()}
    return profile(df, [by], measures | {"avg_area_income": mean(INCOME, 0)}).orderBy(by)


def summary_by_place(df: DataFrame, models: Mapping[str, str], by: str = "borough") -> DataFrame:
    measures = {"avg_income": mean(INCOME, 0), "avg_actual_fare": mean(LABEL)}
    measures |= {f"{n}_predicted": mean(p) for n, p in models.items()}
    measures |= {f"{n}_overcharge_pct": excess(p) for n, p in models.items()}
    return profile(df, [by], measures).orderBy(by)


def model_frames(summary: DataFrame, models: Sequence[str] = ("baseline", "fair")) -> DataFrame:
    """A wide summary in long form: one row per model and group under common column names."""
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"{name}_predicted").alias("avg_predicted_fare"),
            F.col(f"{name}_overcharge_pct").alias("overcharge_pct"),
        )
        for name in models
    ]
    return summary.select("income_category", "trip_count", "avg_actual_fare", F.inline(F.array(*rows)))


def rounded_means_table(df: DataFrame, by: str, models: Mapping[str, str], extra: bool = True) -> DataFrame:
    """Overcharge computed from means already rounded to cents, ties to even.

    This is what tabular reports print: the percentages can be checked by hand against the shown means. The mean
    error stands beside them. Without ``extra`` the mean distance is left out.
    """
    means = {"avg_dist": F.avg(DISTANCE), "actual": F.avg(LABEL)}
    means |= {n: F.avg(p) for n, p in models.items()}
    errors = {f"{n}_avg_error": C.steady_bround(F.avg(F.col(p) - F.col(LABEL)), 2) for n, p in models.items()}
    table = with_rounded_overcharge(profile(df, [by], means | errors, "trips"), models)
    table = table.withColumn("avg_dist", C.steady_bround(F.col("avg_dist"), 2))
    return table if extra else table.drop("avg_dist")


def with_rounded_overcharge(groups: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """Round the group means ``actual`` and those of the models to cents and add the overcharge computed from them."""
    groups = groups.withColumns({c: C.steady_bround(F.col(c), 2) for c in ("actual", *models)})
    pct = {f"{n}_oc_pct": C.steady_bround(C.overcharge_pct(F.col(n), F.col("actual")), 1) for n in models}
    return groups.withColumns(pct)


def controlled_rounded(
    df: DataFrame, by: str, models: Mapping[str, str], target=5.0, tolerance=0.5, min_rows: int = 100
) -> DataFrame:
    """Rounded-means table of comparable trips; ``enough_rows`` says whether they are ``min_rows`` or more.

    With fewer the means stay and the percentages are null.
    """
    table = rounded_means_table(near_distance(df, target, tolerance), by, models)
    everything = Window.partitionBy(F.lit(0))  # over group rows only
    table = table.withColumn("enough_rows", F.sum("trips").over(everything) >= min_rows)
    return table.withColumns({f"{n}_oc_pct": F.when(F.col("enough_rows"), F.col(f"{n}_oc_pct")) for n in models})


def low_high_gap(table: DataFrame, by: str, column: str, low: str = "low", high: str = "high") -> DataFrame:
    """Percent by which the low group's mean lies above the high group's."""
    lo = F.max(F.when(F.col(by) == low, F.col(column)))
    hi = F.max(F.when(F.col(by) == high, F.col(column)))
    sides = table.agg(lo.alias("low_value"), hi.alias("high_value"))
    return sides.withColumn("gap_pct", C.steady_bround(C.overcharge_pct(F.col("low_value"), F.col("high_value")), 1))


def in_order(df: DataFrame, column: str, order: Sequence[str] = INCOME_ORDER) -> DataFrame:
    """Sort by a given order of values; values outside of it are left out."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return df.filter(F.col(column).isin(*order)).orderBy(place)


def chart_summary(df: DataFrame, by: str, models: Mapping[str, str]) -> DataFrame:
    """Group means as charts read them: unrounded, in rising order of income, one row per model and group."""
    measures = {"avg_actual_fare": F.avg(LABEL)}
    measures |= {f"{n}_predicted": F.avg(p) for n, p in models.items()}
    measures |= {
        f"{n}_overcharge_pct": C.steady_bround(C.overcharge_pct(F.avg(p), F.avg(LABEL)), 1) for n, p in models.items()
    }
    long = model_frames(profile(df, [by], measures).withColumnRenamed(by, "income_category"), list(models))
    return in_order(long, "income_category")


def error_total(df: DataFrame, by: str, error: str) -> DataFrame:
    """Summed error per group in millions: signed order, absolute size, groups without error left out."""
    total = df.groupBy(by).agg((F.sum(error) / 1e6).alias("signed_millions"))
    size = F.abs("signed_millions")
    return total.withColumn("millions", size).filter(size > 1e-9).orderBy(F.desc("signed_millions"), by)


def side_by_side(first: DataFrame, second: DataFrame, key: str, columns: Sequence[str], names=("baseline", "fair")) -> DataFrame:
    """Two summaries of the same groups joined on the group."""
    def renamed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in columns])

    return renamed(first, names[0]).join(renamed(second, names[1]), key)


def improvement(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """Whole percent by which the size of an overcharge fell; zero where it was at most 0.1 to begin with."""
    b, a = F.abs(F.col(before)), F.abs(F.col(after))
    gain = F.floor(C.steady_round(F.try_divide(b - a, b) * 100.0, 9) + 0.5)
    return pairs.withColumn("improvement_pct", F.when(b > 0.1, gain).otherwise(F.lit(0).cast("bigint")))


def bias_reduction(table: DataFrame, by: str, before: str, after: str, group: str = "low") -> DataFrame:
    """Reduction of one group's overcharge in percent; zero when there was none."""
    b, a = F.col(before), F.col(after)
    reduction = F.when(b != 0, (1.0 - F.try_divide(a, b)) * 100.0).otherwise(0.0)
    return table.filter(F.col(by) == group).select(by, before, after, C.steady_round(reduction, 4).alias("reduction_pct"))


def share_of_total(counts: DataFrame, key: str, column: str) -> DataFrame:
    """Each group's share of the total and its size relative to the largest group."""
    everything = Window.partitionBy(F.lit(0))  # over group rows only
    n = F.col(column)
    return counts.select(
        key,
        column,
        F.round(n / F.sum(n).over(everything) * 100.0, 1).alias("share_pct"),
        F.round(n / F.max(n).over(everything) * 100.0, 1).alias("of_largest_pct"),
    )
