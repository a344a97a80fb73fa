"""Cleaning and feature derivation of trip records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand import schemas
from evenhand.fixed_values import WIDE_BOX_LIMITS, TripLimits
from evenhand.functions import columns as C
from evenhand.sources.files import FAULTY_LINE, fault_fields

COORDINATES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
CRITICAL = ("tpep_pickup_datetime", "tpep_dropoff_datetime", *COORDINATES, "trip_distance", "fare_amount")


def all_of(conditions) -> Column:
    return reduce(Column.__and__, conditions)


def complete() -> Column:
    """No critical field is null."""
    return all_of(F.col(c).isNotNull() for c in CRITICAL)


def located() -> Column:
    """No coordinate is zero, which is how a lost position is recorded."""
    return all_of(F.col(c) != 0.0 for c in COORDINATES)


def trip_minutes() -> Column:
    return C.minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime")


def plausible(limits: TripLimits = TripLimits()) -> Column:
    """All limits that are switched on hold. A null passenger count fails its limit."""
    distance, minutes = F.col("trip_distance"), trip_minutes()
    ends = ("pickup", "dropoff") if limits.check_dropoff else ("pickup",)
    rules = [F.col("fare_amount").between(*limits.fare), distance > 0, distance <= limits.max_distance]
    for end in ends:
        rules.append(F.col(f"{end}_latitude").between(*limits.lat))
        rules.append(F.col(f"{end}_longitude").between(*limits.lon))
    if limits.max_passengers is not None:
        rules.append(F.col("passenger_count").between(1, limits.max_passengers))
    # rules that compute something come last: they run only on rows that passed the others
    if limits.max_minutes is not None:
        rules += [minutes > 0, minutes <= limits.max_minutes]
    if limits.max_mph is not None:
        moving = limits.max_minutes is not None  # then zero minutes are out already
        mph = F.round(F.try_divide(distance, minutes / 60.0), 2) if moving else C.miles_per_hour(distance, minutes)
        rules.append(mph <= limits.max_mph)
    return all_of(rules)


def drop_incomplete(trips: DataFrame) -> DataFrame:
    return trips.filter(complete())


def keep_valid(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Complete, located and plausible rows with all their columns: one filter that reaches the scan."""
    return trips.filter(complete() & located() & plausible(limits))


def keep_valid_wide(trips: DataFrame) -> DataFrame:
    """The exploratory variant: fare, distance and a wider pickup box, nothing else."""
    return trips.filter(plausible(WIDE_BOX_LIMITS))


def with_features(trips: DataFrame) -> DataFrame:
    """Add duration, speed, calendar flags, fare per mile, grid key and content id."""
    hour, day = F.hour("tpep_pickup_datetime"), F.dayofweek("tpep_pickup_datetime")
    distance = F.col("trip_distance")
    return trips.withColumns(
        {
            "trip_duration_minutes": trip_minutes(),
            "speed_mph": C.miles_per_hour(distance, trip_minutes()),
            "hour_of_day": hour,
            "day_of_week": day,
            "is_rush_hour": C.rush_hour(hour, day),
            "is_weekend": day.isin(1, 7),
            "is_night": (hour >= 22) | (hour <= 5),
            "fare_per_mile": C.per_mile(F.col("fare_amount"), distance),
            "pickup_zone": C.grid_key("pickup_latitude", "pickup_longitude"),
            "trip_id": C.content_id(
                "tpep_pickup_datetime", "pickup_latitude", "pickup_longitude", "fare_amount", "trip_distance"
            ),
        }
    )


def clean_trips(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Valid trips with features, in the declared column order."""
    return with_features(keep_valid(trips, limits)).select(*schemas.CLEAN_TRIPS.fieldNames())


def step_counts(limits: TripLimits = TripLimits()) -> list[Column]:
    """Aggregates that count the rows left after each cleaning step."""
    steps = {"after_nulls": complete(), "after_zero_gps": located(), "after_outliers": plausible(limits)}
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("initial_rows")]
    for name, rule in steps.items():
        passed = passed & rule
        counts.append(F.count_if(passed).alias(name))
    return counts


def with_removed_share(counts: DataFrame) -> DataFrame:
    removed = F.try_divide(F.col("initial_rows") - F.col("after_outliers"), F.col("initial_rows")) * 100.0
    return counts.withColumn("removed_pct", F.round(removed, 1))


def funnel(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Rows left after each cleaning step, from one pass over the input."""
    return with_removed_share(trips.agg(*step_counts(limits)))


def cleaned_and_faulty(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Rows to write from one pass over trips with a ``faulty_line``, by ``kind``.

    ``cleaned`` are the valid trips with features; ``faulty`` are lines of which something was lost, with the fields
    it was lost from. A faulty line whose lost cells do not matter for cleaning is of both kinds.
    """
    line = F.col(FAULTY_LINE)
    kinds = F.array_compact(F.array(F.when(complete() & located() & plausible(limits), "cleaned"), F.when(line.isNotNull(), "faulty")))
    rows = with_features(trips.withColumn("lost_fields", fault_fields()).withColumn("kind", F.explode(kinds)))
    is_faulty = F.col("kind") == "faulty"
    faults = [F.when(is_faulty, F.col(c)).alias(c) for c in (FAULTY_LINE, "lost_fields")]
    return rows.select(*[F.when(~is_faulty, F.col(c)).alias(c) for c in schemas.CLEAN_TRIPS.fieldNames()], *faults, "kind")


def type_fields(records: DataFrame, ints=schemas.INT_FIELDS, doubles=schemas.DOUBLE_FIELDS) -> DataFrame:
    """Turn text fields into typed ones; blank or malformed text becomes null. Works on streams as well."""
    typed = {}
    for name in records.columns:
        raw = F.col(name)
        if name in ints:
            typed[name] = C.text_to_int(raw)
        elif name in doubles:
            typed[name] = C.text_to_double(raw)
        else:
            typed[name] = C.text_value(raw)
    return records.select(*[expr.alias(name) for name, expr in typed.items()])


def stamp_ingestion(records: DataFrame) -> DataFrame:
    """Add the intake time as ISO-8601 text in UTC; constant within a batch, so replays agree."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return records.withColumn("ingestion_timestamp", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
