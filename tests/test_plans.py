"""What the optimizer makes of the operators: pushed filters, pruned columns, no stray shuffles or Python."""

from __future__ import annotations

import re

import pytest

from checks.queries import QUERIES
from evenhand.operators import cleaning, disparity, enrich, fairness, lookup
from checks import fixture as fx
from evenhand.sources import files

MODELS = fx.MODELS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df) -> str:
    """The plan before any stage has run."""
    return plan_of(df).split("== Initial Plan ==")[-1]


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    folder = tmp_path_factory.mktemp("tables")
    files.write_parquet(fx.raw_trips(spark, sf), f"{folder}/raw")
    files.write_parquet(fx.predicted_trips(spark, sf), f"{folder}/predictions")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in ("raw", "predictions")}


def test_cleaning_limits_reach_the_scan(tables):
    plan = plan_of(cleaning.clean_trips(tables["raw"]))
    pushed = re.search(r"PushedFilters: \[(.*)", plan).group(1)
    for rule in ("IsNotNull(fare_amount)", "GreaterThanOrEqual(fare_amount,2.5)", "LessThanOrEqual(trip_distance,100.0)",
                 "GreaterThanOrEqual(pickup_latitude,40.49)", "LessThanOrEqual(dropoff_longitude,-73.68)"):
        assert rule in pushed
    assert "Exchange" not in plan


def test_reports_read_only_their_columns_and_shuffle_group_rows_only(tables):
    table = disparity.controlled_table(tables["predictions"], "income_category", MODELS)
    plan = plan_of(table)
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {
        "income_category", "trip_distance", "fare_amount", "predicted_fare_baseline", "predicted_fare_fair"
    }
    assert "GreaterThanOrEqual(trip_distance,4.5)" in plan
    assert initial(table).count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan


def test_enrichment_never_shuffles_trips(spark, sf, tables):
    trips = cleaning.with_features(cleaning.keep_valid(tables["raw"]))
    enriched = enrich.enrich_trips(trips, lookup.zone_table(spark), fx.census_text(spark, sf))
    fact_side = initial(enriched).split("BroadcastExchange")[0]
    assert "Exchange" not in fact_side and "raw" in fact_side
    assert "NestedLoop" not in initial(enriched) and "Python" not in initial(enriched)


def test_both_spreads_come_from_one_aggregation(tables):
    scores = fairness.group_scores(tables["predictions"], MODELS)
    assert initial(scores).count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith(("rf_", "stream_", "model_r"))}))
def test_no_query_plans_a_nested_loop_or_a_row_function(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert bad not in plan
