"""Report documents: one row of nested values, ready for a JSON sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.operators import disparity, fairness, impact, stats
from evenhand.operators.joins import one_row
from evenhand.session import written


def bias_report(df: DataFrame, models: Mapping[str, str], group: str = "income_category") -> DataFrame:
    """Overcharge of low and high groups, tests of the baseline errors and yearly impact.

    One aggregation over the rows gives the moments of every group; all else works on those few rows.
    """
    error = "baseline_error"
    moments = written(
        df.groupBy(group).agg(
            F.count(F.lit(1)).alias("trips"), F.avg(disparity.LABEL).alias("actual"), *[F.avg(p).alias(n) for n, p in models.items()],
            F.count(error).alias("n"), F.avg(error).alias("m"), F.var_samp(error).alias("v"),
        ),
        "moments",
    )
    table = disparity.with_rounded_overcharge(moments, models)

    def pct(model: str, member: str) -> Column:
        return F.max(F.when(F.col(group) == member, F.col(f"{model}_oc_pct")))

    low, high = pct("baseline", "low"), pct("baseline", "high")
    summary = table.agg(
        F.struct(
            low.alias("baseline_low_overcharge_pct"),
            high.alias("baseline_high_overcharge_pct"),
            pct("fair", "low").alias("fair_low_overcharge_pct"),
            F.round(low - high, 9).alias("bias_magnitude_pp"),
        ).alias("summary")
    )
    tests = stats.with_p_value(stats.with_effect(stats.compare_moments(moments, group)))
    body = F.struct("t_stat", "p_value", "significant", "cohens_d", "effect_size", "enough_rows")
    by_test = tests.agg(F.map_from_entries(F.collect_list(F.struct("test", body))).alias("statistical_tests"))
    member = F.col(group) == "low"
    sums = moments.agg(
        F.sum("trips").alias("rows"), F.coalesce(F.sum(F.when(member, F.col("trips"))), F.lit(0)).alias("group_rows"),
        F.max(F.when(member, F.col("m"))).alias("avg_overcharge"),
    )
    money = impact.projected(sums).select(
        F.struct(
            F.col("avg_overcharge").alias("avg_overcharge_per_trip"),
            F.col("annual_trips").alias("affected_trips_annually"),
            F.col("annual_impact_usd").alias("total_annual_impact_usd"),
        ).alias("financial_impact")
    )
    return one_row(summary, by_test, money).withColumn("date", F.current_timestamp())


def fairness_report(df: DataFrame, models: Mapping[str, str], keys: Sequence[str], **pairing) -> DataFrame:
    """The three scores of every model with their details, and the improvement between the models."""
    groups = written(fairness.group_scores(df, models), "groups")  # a few rows that two metrics read
    pairs = fairness.partner_pairs(df, models, keys, **pairing)
    tables = {
        "demographic_parity": fairness.demographic_parity(groups),
        "equalized_odds": fairness.equalized_odds(groups),
        "individual_fairness": fairness.individual_fairness(pairs, models),
    }
    per_model = []
    for metric, table in tables.items():
        body = F.struct(*[c for c in table.columns if c != "model"])
        per_model.append(table.agg(F.map_from_entries(F.collect_list(F.struct("model", body))).alias(metric)))
    return one_row(*per_model).withColumn("date", F.current_timestamp())


METRICS = ("demographic_parity", "equalized_odds", "individual_fairness")


def with_comparison(report: DataFrame, before: str = "baseline", after: str = "fair") -> DataFrame:
    """Add the improvements, computed from the scores in the report itself."""
    gains = []
    for metric in METRICS:
        b, a = F.col(metric)[before]["score"], F.col(metric)[after]["score"]
        gains.append(F.when(b > 0, (b - a) / b * 100.0).otherwise(0.0))
    overall = (gains[0] + gains[1] + gains[2]) / 3.0
    return report.withColumn(
        "comparison", F.struct(*[g.alias(m) for g, m in zip(gains, METRICS)], overall.alias("overall"))
    )


def comparison_rows(report: DataFrame, before: str = "baseline", after: str = "fair") -> DataFrame:
    """The comparison of a report as rows of ``metric, baseline_score, fair_score, improvement_pct``."""
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric)[before]["score"].alias("baseline_score"),
            F.col(metric)[after]["score"].alias("fair_score"),
            F.col("comparison")[metric].alias("improvement_pct"),
        )
        for metric in METRICS
    ]
    nothing = F.lit(None).cast("double")
    overall = F.struct(
        F.lit("overall").alias("metric"), nothing.alias("baseline_score"), nothing.alias("fair_score"),
        F.col("comparison")["overall"].alias("improvement_pct"),
    )
    return report.select(F.inline(F.array(*rows, overall)))
