"""The whole audit, stage by stage, from files to files.

    python -m evenhand.plans.audit --raw 'data/trips_*.csv' --census data/income.csv --out output

Every stage reads what the one before wrote, so each can be repeated alone.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenhand import schemas
from evenhand.fixed_values import TripLimits
from evenhand.operators import cleaning, disparity, enrich, lookup, models, reports
from evenhand.session import build_session, fit_shuffles
from evenhand.sources import files

MODELS = {"baseline": "predicted_fare_baseline", "fair": "predicted_fare_fair"}
INCOME = "income_category"
FIT_PART = 0.8  # of the drawn trips


@dataclass(frozen=True)
class Paths:
    """Where everything lives. All stages and tables take their places from here."""

    raw: str
    census: str
    out: str

    @property
    def trips(self) -> str:
        return f"{self.out}/processed/trips"

    @property
    def cleaned(self) -> str:
        """Where a table of the cleaned trips alone finds them."""
        return f"{self.trips}/kind=cleaned"

    @property
    def enriched(self) -> str:
        return f"{self.out}/processed/enriched"

    @property
    def models(self) -> str:
        return f"{self.out}/models"

    @property
    def predictions(self) -> str:
        return f"{self.out}/results/predictions"

    @property
    def comparison(self) -> str:
        return f"{self.out}/results/model_comparison"

    @property
    def bias(self) -> str:
        return f"{self.out}/results/bias_analysis"

    @property
    def fairness(self) -> str:
        return f"{self.out}/results/fairness_metrics"


def clean(spark: SparkSession, paths: Paths, limits: TripLimits = TripLimits()) -> DataFrame:
    """Raw files to cleaned trips and faulty lines; returns the rows left after each step and the faulty ones.

    The raw files are read once: the counts are taken from the rows on their way to the output.
    """
    raw = files.read_trips_checked(spark, paths.raw)
    seen = Observation("funnel")
    counted = raw.observe(seen, *cleaning.step_counts(limits), F.count(files.FAULTY_LINE).alias("faulty_rows"))
    files.write_kinds(cleaning.cleaned_and_faulty(counted, limits), paths.trips)
    names = ["initial_rows", "after_nulls", "after_zero_gps", "after_outliers", "faulty_rows"]
    row = [seen.get.get(name, 0) for name in names]
    return cleaning.with_removed_share(spark.createDataFrame([row], ", ".join(f"{name} bigint" for name in names)))


def cleaned_trips(spark: SparkSession, paths: Paths) -> DataFrame:
    return files.read_kind(spark, paths.trips, schemas.CLEAN_TRIPS, "cleaned")


def faulty_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Lines of the raw files of which something was lost, with the names of the fields."""
    return files.read_kind(spark, paths.trips, schemas.FAULTY_LINES, "faulty")


def add_income(spark: SparkSession, paths: Paths, out_files: int | None = None) -> DataFrame:
    """Cleaned to enriched trips; returns the profile by income band.

    ``out_files`` merges the output into that many files, for inputs small enough to be written by as many tasks.
    """
    trips = cleaned_trips(spark, paths)
    fit_shuffles(trips)
    enriched = enrich.enrich_trips(trips, lookup.zone_table(spark), files.read_census_csv(spark, paths.census))
    files.write_parquet(enriched.select(*schemas.ENRICHED_TRIPS.fieldNames()), paths.enriched, out_files)
    measures = {
        "avg_fare": disparity.mean("fare_amount"),
        "avg_distance": disparity.mean("trip_distance"),
        "avg_area_income": disparity.mean("median_income", 0),
    }
    return disparity.profile(files.read_parquet(spark, paths.enriched), [INCOME], measures).orderBy(INCOME)


def train(
    spark: SparkSession, paths: Paths, fraction: float = 0.05, out_files: int | None = None
) -> DataFrame:
    """Enriched trips to models, predictions and group summaries; returns the models' errors.

    The forests grow on four fifths of a ``fraction`` of the trips, drawn by their ids. Predictions cover every
    trip that they did not see, so later reports stand on all trips but those few.
    """
    trips = files.read_parquet(spark, paths.enriched)
    fit_shuffles(trips)
    trained = models.train(trips, ["trip_id"], train_part=FIT_PART * fraction)
    trained.save(paths.models)
    files.write_parquet(trained.score().select(*schemas.PREDICTIONS.fieldNames()), paths.predictions)
    files.write_small_csv(trained.importances(spark), f"{paths.models}/importances")

    predicted = files.read_parquet(spark, paths.predictions)
    files.write_small_csv(disparity.summary_by_income(predicted, MODELS), f"{paths.bias}/bias_summary_csv")
    files.write_small_csv(disparity.summary_by_place(predicted, MODELS), f"{paths.bias}/borough_bias_csv")
    files.write_rows_csv(predicted.select(*schemas.COMPARISON_COLUMNS), paths.comparison, out_files)
    return models.regression_metrics(predicted, MODELS)


def detect_bias(spark: SparkSession, paths: Paths) -> DataFrame:
    """Predictions to the bias report; returns the table of groups and models."""
    predicted = files.read_parquet(spark, paths.predictions)
    files.write_report_json(reports.bias_report(predicted, MODELS), f"{paths.bias}/bias_report")
    table = disparity.rounded_means_table(predicted, INCOME, MODELS)
    files.write_small_csv(table, f"{paths.bias}/bias_summary_rounded_csv")
    return table


def measure_fairness(spark: SparkSession, paths: Paths, sample: int | None = None) -> DataFrame:
    """Predictions to the fairness report; returns the improvement per metric, read from the written report."""
    predicted = files.read_parquet(spark, paths.predictions)
    fit_shuffles(predicted)
    report = reports.with_comparison(reports.fairness_report(predicted, MODELS, ["trip_id"], sample=sample))
    files.write_report_json(report, f"{paths.fairness}/report")
    return reports.comparison_rows(spark.read.json(f"{paths.fairness}/report"))


STAGES = {
    "clean": clean, "enrich": add_income, "train": train, "bias": detect_bias, "fairness": measure_fairness,
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Audit fares and fare predictions for group disparity.")
    parser.add_argument("--raw", required=True, help="CSV files of trips, a glob")
    parser.add_argument("--census", required=True, help="CSV file of income by postal code")
    parser.add_argument("--out", required=True, help="folder for all output")
    parser.add_argument("--fraction", type=float, default=0.05, help="part of the trips to train on")
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=list(STAGES))
    chosen = parser.parse_args(arguments)
    spark = build_session("fare-audit")
    paths = Paths(chosen.raw, chosen.census, chosen.out)
    for name in chosen.stages:
        options = {"fraction": chosen.fraction} if name == "train" else {}
        table = STAGES[name](spark, paths, **options)
        print(name)
        table.show(truncate=False)


if __name__ == "__main__":
    main()
