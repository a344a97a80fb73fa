"""Column expressions on the rows where rules are easy to get wrong."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from evenhand import schemas
from evenhand.fixed_values import TripLimits, zone_rows
from evenhand.functions import columns as C
from evenhand.functions.t_tail import two_sided
from evenhand.operators import cleaning


def values(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_band_bounds_belong_to_the_upper_band_and_bin_bounds_to_the_lower(spark):
    rows = [(44999.99,), (45000.0,), (74999.99,), (75000.0,), (75000.01,)]
    assert values(spark, C.income_band(F.col("x")), rows, "x double") == ["low", "medium", "medium", "high", "high"]
    assert values(spark, C.income_bin(F.col("x")), rows, "x double") == ["low", "low", "medium", "medium", "high"]
    assert values(spark, C.income_bin(F.col("x")), [(None,), (0.0,), (-1.0,)], "x double") == [None, None, None]


def test_rush_hour_covers_the_last_full_hour_on_weekdays_only(spark):
    rows = [(6, 2), (7, 2), (9, 6), (10, 3), (17, 4), (19, 4), (20, 4), (8, 1), (8, 7)]
    found = values(spark, C.rush_hour(F.col("h"), F.col("d")), rows, "h int, d int")
    assert found == [False, True, True, False, True, True, False, False, False]


def test_text_is_typed_and_bad_text_is_null(spark):
    rows = [("3",), (" 3.9 ",), ("",), ("  ",), (None,), ("x",), ("1e2",), ("99999999999",)]
    assert values(spark, C.text_to_int(F.col("t")), rows, "t string") == [3, 3, None, None, None, None, 100, None]
    rows = [("1.23456789",), (" -0.5 ",), ("-",), ("",)]
    assert values(spark, C.text_to_double(F.col("t")), rows, "t string") == [1.234568, -0.5, None, None]


def test_grid_key_rounds_ties_to_even_and_prints_short(spark):
    rows = [(40.705, -74.005), (40.715, -73.995), (40.7, -74.0)]
    found = values(spark, C.grid_key("a", "b"), rows, "a double, b double")
    assert found == ["40.7_-74.0", "40.72_-74.0", "40.7_-74.0"]


def test_labels_and_gains(spark):
    assert values(spark, C.grade(F.col("x"), (0.5, 1.5)), [(0.49,), (0.5,), (1.5,)], "x double") == ["GOOD", "MODERATE", "POOR"]
    assert values(spark, C.effect_label(F.col("x"), (0.5, 0.8)), [(-0.81,), (0.8,), (0.5,)], "x double") == ["large", "medium", "small"]
    gains = values(spark, C.relative_gain(F.col("b"), F.col("a")), [(4.0, 1.0), (0.0, 1.0), (2.0, 3.0)], "b double, a double")
    assert gains == [75.0, 0.0, -50.0]
    assert values(spark, C.clip(F.col("x"), 1.0, 2.0), [(0.0,), (1.5,), (9.0,), (None,)], "x double") == [1.0, 1.5, 2.0, None]


def test_rounding_does_not_depend_on_the_last_bits(spark):
    rows = [(27.134999999999998,), (27.135,), (27.135000000000005,)]
    assert values(spark, C.steady_round(F.col("x"), 2), rows, "x double") == [27.14] * 3
    assert values(spark, C.steady_bround(F.col("x"), 2), [(0.125,), (0.375,)], "x double") == [0.12, 0.38]


def test_content_id_skips_nulls_and_repeats(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a", "b", "c")]
    first, second, third = values(spark, C.content_id("x", "y", "z"), rows, "x string, y string, z string")
    assert first == second != third and len(first) == 16


@pytest.mark.parametrize(
    "t, df, p", [(2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.959964, 1e7, 0.05), (3.29, 1e6, 0.001002), (0.0, 5, 1.0), (4.587, 10, 0.001)]
)
def test_tail_probability_matches_printed_tables(spark, t, df, p):
    rows = [(float(t), float(df)), (-float(t), float(df))]
    found = values(spark, two_sided(F.col("x"), F.col("y")), rows, "x double, y double")
    assert found == pytest.approx([p, p], rel=2e-3)


def test_tail_probability_over_many_degrees_of_freedom(spark):
    """Against the closed form for 2 degrees of freedom and the normal tail for many."""
    rows = [(t, df) for t in (0.5, 2.0, 6.0, 12.0) for df in (2.0, 1e9, 1e11)] + [(float("nan"), 3.0), (float("inf"), 3.0), (None, 3.0)]
    found = values(spark, two_sided(F.col("x"), F.col("y")), rows, "x double, y double")
    expected = [1 - t / math.sqrt(2 + t * t) if df == 2 else math.erfc(t / math.sqrt(2)) for t, df in rows[:12]]
    assert found == [*[pytest.approx(p, rel=1e-6) for p in expected], None, 0.0, None]


def test_zone_list_is_whole():
    rows = zone_rows()
    assert len(rows) == 72 and [r[0] for r in rows] == list(range(72))
    boroughs = [r[6] for r in rows]
    assert {b: boroughs.count(b) for b in set(boroughs)} == {
        "Manhattan": 30, "Brooklyn": 18, "Queens": 13, "Bronx": 9, "Staten Island": 2,
    }


BASE = {
    "tpep_pickup_datetime": dt.datetime(2016, 1, 4, 8, 0), "tpep_dropoff_datetime": dt.datetime(2016, 1, 4, 8, 30),
    "passenger_count": 1, "trip_distance": 5.0, "pickup_longitude": -74.0, "pickup_latitude": 40.7,
    "dropoff_longitude": -73.9, "dropoff_latitude": 40.8, "fare_amount": 20.0, "total_amount": 24.0,
}


def trips(spark, *changes):
    names = schemas.RAW_TRIPS.fieldNames()
    return spark.createDataFrame([tuple({**BASE, **c}.get(n) for n in names) for c in changes], schemas.RAW_TRIPS)


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"fare_amount": 2.5}, True), ({"fare_amount": 2.49}, False), ({"fare_amount": 500.0}, True),
        ({"fare_amount": 500.01}, False), ({"fare_amount": None}, False),
        ({"trip_distance": 0.0}, False), ({"trip_distance": 50.0}, True), ({"trip_distance": 50.01}, False),
        ({"passenger_count": None}, False), ({"passenger_count": 0}, False), ({"passenger_count": 9}, True),
        ({"passenger_count": 10}, False),
        ({"tpep_dropoff_datetime": dt.datetime(2016, 1, 4, 8, 0)}, False),
        ({"tpep_dropoff_datetime": dt.datetime(2016, 1, 4, 13, 0)}, True),
        ({"tpep_dropoff_datetime": dt.datetime(2016, 1, 4, 13, 1)}, False),
        ({"pickup_latitude": 40.49}, True), ({"pickup_latitude": 40.93}, False),
        ({"dropoff_longitude": -74.28}, False), ({"dropoff_latitude": 0.0}, False), ({"pickup_longitude": None}, False),
    ],
)
def test_limits(spark, change, kept):
    assert cleaning.clean_trips(trips(spark, change)).count() == int(kept)


def test_cleaning_reads_zero_distance_without_an_error_even_when_cached(spark):
    featured = cleaning.with_features(trips(spark, {}, {"trip_distance": 0.0})).cache()
    assert sorted(r["fare_per_mile"] is None for r in featured.collect()) == [False, True]
    featured.unpersist()


def test_features_and_funnel(spark):
    row = cleaning.clean_trips(trips(spark, {})).first()
    assert (row["trip_duration_minutes"], row["speed_mph"], row["hour_of_day"], row["day_of_week"]) == (30.0, 10.0, 8, 2)
    assert (row["is_rush_hour"], row["is_weekend"], row["is_night"], row["fare_per_mile"]) == (True, False, False, 4.0)
    found = cleaning.funnel(trips(spark, {}, {"fare_amount": None}, {"pickup_latitude": 0.0}, {"fare_amount": 1.0})).first()
    assert tuple(found) == (4, 3, 2, 1, 75.0)


def test_speed_limit_alone_lets_standing_trips_pass(spark):
    standing = {"tpep_dropoff_datetime": BASE["tpep_pickup_datetime"]}
    limits = TripLimits(max_minutes=None)
    assert cleaning.keep_valid(trips(spark, standing), limits).count() == 1


def test_stamp_is_iso_utc(spark):
    stamped = cleaning.stamp_ingestion(trips(spark, {})).first()["ingestion_timestamp"]
    assert abs(dt.datetime.now(dt.timezone.utc) - dt.datetime.fromisoformat(stamped)) < dt.timedelta(minutes=5)
