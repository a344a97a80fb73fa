"""Database, external tables and analytical views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenhand import schemas
from evenhand.operators.disparity import excess, mean, profile

CSV = {"header": "true", "nullValue": "", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
PARQUET = {"compression": "snappy"}

# table name: schema, format and options
TABLES: dict[str, tuple[StructType, str, dict[str, str]]] = {
    "taxi_trips_raw": (schemas.RAW_TRIPS, "csv", CSV),
    "census_income": (schemas.CENSUS, "csv", CSV),
    "taxi_trips_cleaned": (schemas.CLEAN_TRIPS, "parquet", PARQUET),
    "taxi_trips_enriched": (schemas.ENRICHED_TRIPS, "parquet", PARQUET),
    "ml_predictions": (schemas.PREDICTIONS, "parquet", PARQUET),
    "bias_summary": (schemas.BIAS_SUMMARY, "csv", CSV),
    "borough_bias": (schemas.BOROUGH_BIAS, "csv", CSV),
}


def use_database(spark: SparkSession, name: str = "fare_audit") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def create_table(spark: SparkSession, name: str, path: str) -> None:
    """(Re)define one external table over files at ``path``; the files stay when it is dropped."""
    schema, kind, options = TABLES[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {kind} OPTIONS ({listed}) LOCATION '{path}'")


def create_tables(spark: SparkSession, paths: dict[str, str], database: str = "fare_audit") -> None:
    use_database(spark, database)
    for name, path in paths.items():
        create_table(spark, name, path)


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def income_fare_summary(enriched: DataFrame) -> DataFrame:
    measures = {
        "avg_distance": mean("trip_distance"),
        "avg_fare": mean("fare_amount"),
        "avg_fare_per_mile": mean("fare_per_mile"),
        "avg_median_income": mean("median_income", 0),
    }
    return profile(enriched, ["income_category"], measures)


def borough_stats(enriched: DataFrame) -> DataFrame:
    measures = {
        "avg_fare": mean("fare_amount"), "avg_distance": mean("trip_distance"), "avg_income": mean("median_income", 0)
    }
    return profile(enriched, ["borough"], measures)


def hourly_demand(enriched: DataFrame) -> DataFrame:
    return profile(enriched, ["hour_of_day", "income_category"], {"avg_fare": mean("fare_amount")})


def bias_comparison(predictions: DataFrame) -> DataFrame:
    models = {"baseline": "predicted_fare_baseline", "fair": "predicted_fare_fair"}
    measures = {"avg_actual": mean("fare_amount")}
    measures |= {f"{n}_avg": mean(p) for n, p in models.items()}
    measures |= {f"{n}_oc_pct": excess(p) for n, p in models.items()}
    return profile(predictions, ["income_category"], measures, "trips")


def define_views(enriched: DataFrame, predictions: DataFrame) -> None:
    """Register the four views and the two tables they read; each is computed when it is queried."""
    enriched.createOrReplaceTempView("taxi_trips_enriched")
    predictions.createOrReplaceTempView("ml_predictions")
    income_fare_summary(enriched).createOrReplaceTempView("v_income_fare_summary")
    borough_stats(enriched).createOrReplaceTempView("v_borough_stats")
    hourly_demand(enriched).createOrReplaceTempView("v_hourly_demand")
    bias_comparison(predictions).createOrReplaceTempView("v_bias_comparison")


def fare_per_mile_of(group: str, enriched: DataFrame) -> DataFrame:
    """Mean of each trip's own fare per mile, unrounded per trip."""
    ratio = F.try_divide(F.col("fare_amount"), F.nullif(F.col("trip_distance"), F.lit(0.0)))
    return enriched.filter(F.col("trip_distance") > 0).groupBy(group).agg(F.avg(ratio).alias("fare_per_mile"))
