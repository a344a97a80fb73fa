"""Declared schemas of the files and tables this package reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def _schema(text: str) -> StructType:
    """Nullable fields from "name type, ..."; unlike ``fromDDL`` it needs no running session."""
    pairs = (item.split() for item in text.split(","))
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


RAW_TRIPS = _schema(
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, pickup_longitude double, pickup_latitude double, RatecodeID int, "
    "store_and_fwd_flag string, dropoff_longitude double, dropoff_latitude double, payment_type int, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double"
)

CENSUS = _schema(
    "zip_code string, geography string, geographic_area_name string, households double, "
    "households_margin_error double, median_income double, median_income_margin_error double, "
    "mean_income double, mean_income_margin_error double, year int"
)

CLEAN_TRIPS = _schema(
    "trip_id string, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, pickup_longitude double, pickup_latitude double, dropoff_longitude double, "
    "dropoff_latitude double, fare_amount double, total_amount double, trip_duration_minutes double, "
    "speed_mph double, hour_of_day int, day_of_week int, is_rush_hour boolean, is_weekend boolean, "
    "is_night boolean, fare_per_mile double, pickup_zone string"
)

ENRICHED_TRIPS = StructType(
    CLEAN_TRIPS.fields
    + _schema(
        "pickup_zip string, borough string, neighborhood string, median_income double, income_category string"
    ).fields
)

FAULTY_LINES = StructType([StructField("faulty_line", StringType()), StructField("lost_fields", ArrayType(StringType()))])

PREDICTIONS = _schema(
    "trip_id string, fare_amount double, predicted_fare_baseline double, predicted_fare_fair double, "
    "baseline_error double, fair_error double, baseline_abs_error double, fair_abs_error double, "
    "income_category string, borough string, neighborhood string, trip_distance double, "
    "trip_duration_minutes double, median_income double"
)

COMPARISON_COLUMNS = (
    "trip_id", "fare_amount", "trip_distance", "trip_duration_minutes", "income_category", "borough",
    "median_income", "predicted_fare_baseline", "predicted_fare_fair", "baseline_error", "fair_error",
)

BIAS_SUMMARY = _schema(
    "income_category string, trip_count bigint, avg_distance double, avg_actual_fare double, "
    "baseline_predicted double, fair_predicted double, baseline_avg_error double, fair_avg_error double, "
    "baseline_overcharge_pct double, fair_overcharge_pct double, avg_area_income double"
)

BOROUGH_BIAS = _schema(
    "borough string, trip_count bigint, avg_income double, avg_actual_fare double, baseline_predicted double, "
    "fair_predicted double, baseline_overcharge_pct double, fair_overcharge_pct double"
)

INT_FIELDS = tuple(f.name for f in RAW_TRIPS if f.dataType.typeName() == "integer")
DOUBLE_FIELDS = tuple(f.name for f in RAW_TRIPS if f.dataType.typeName() == "double")

# A message carries the raw fields with times as text, plus the time it was taken in.
MESSAGE = _schema(
    ", ".join(
        f"{f.name} {'string' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}"
        for f in RAW_TRIPS
    )
    + ", ingestion_timestamp string"
)
