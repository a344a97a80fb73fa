"""Box lookup, joins and the band pairing against brute force, and their plans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenhand.fixed_values import borough_rows, zone_rows
from evenhand import session
from evenhand.operators import band, enrich, joins, lookup
from evenhand.operators.band import nearest_in_band
from checks import fixture as fx


def first(rows, lat, lon, closed):
    if lat is None or lon is None or lat == 0 or lon == 0:
        return None
    for row in rows:
        _, y0, y1, x0, x1 = row[:5]
        if y0 <= lat and x0 <= lon and (lat <= y1 and lon <= x1 if closed else lat < y1 and lon < x1):
            return row[5]
    return None


def points_around(rows, seed=1, extra=2000):
    """All corners and edges of the boxes, nudged by one float step, and random points."""
    from math import inf, nextafter

    rng = random.Random(seed)
    ys = [y for r in rows for y in r[1:3]]
    xs = [x for r in rows for x in r[3:5]]
    found = []
    for r in rows:
        for y in r[1:3]:
            for x in r[3:5]:
                found += [(y, x), (nextafter(y, -inf), x), (y, nextafter(x, -inf)), (nextafter(y, inf), nextafter(x, inf))]
    found += [(rng.uniform(min(ys), max(ys)), rng.uniform(min(xs), max(xs))) for _ in range(extra)]
    return found + [(0.0, -74.0), (40.7, 0.0), (None, -74.0), (40.7, None), (float("nan"), -74.0), (1e300, -74.0), (-40.7, 74.0)]


@pytest.mark.parametrize("how", [{}, {"cell": 0.0037}, {"cell": 5.0}, {"max_cells": 1}, {"max_cells": 400}])
def test_zone_lookup_equals_a_scan_of_the_list(spark, how):
    points = points_around(zone_rows())
    table = spark.createDataFrame(points, "lat double, lon double")
    found = lookup.first_match(table, lookup.zone_table(spark), ["zip"], "lat", "lon", **how).collect()
    expected = sorted((str(p), first(zone_rows(), *p, False) or "") for p in points)
    assert sorted((str((r["lat"], r["lon"])), r["zip"] or "") for r in found) == expected


def test_unmatched_points_can_be_dropped(spark):
    points = points_around(zone_rows(), extra=300)
    table = spark.createDataFrame(points, "lat double, lon double")
    zones = lookup.zone_table(spark)
    expected = sum(first(zone_rows(), *p, False) is not None for p in points)
    for how in ({}, {"max_cells": 1}):
        assert lookup.first_match(table, zones, ["zip"], "lat", "lon", keep_unmatched=False, **how).count() == expected


def test_borough_lookup_includes_edges(spark):
    points = points_around(borough_rows())
    table = spark.createDataFrame(points, "lat double, lon double")
    expected = sorted((str(p), first(borough_rows(), *p, True) or "Unknown") for p in points)
    by_list = table.select("lat", "lon", lookup.borough_of("lat", "lon").alias("b")).collect()
    assert sorted((str((r["lat"], r["lon"])), r["b"]) for r in by_list) == expected
    by_cells = lookup.first_match(table, lookup.borough_table(spark), ["borough"], "lat", "lon", closed=True).collect()
    assert sorted((str((r["lat"], r["lon"])), r["borough"] or "Unknown") for r in by_cells) == expected


def test_copies_of_a_box_fall_to_the_first(spark):
    rows = [(i, 0.1, 0.3, 0.1, 0.3, f"z{i}") for i in range(200)] + [(200, 0.2, 0.9, 0.2, 0.9, "wide")]
    boxes = spark.createDataFrame(rows, "priority int, lat_from double, lat_to double, lon_from double, lon_to double, name string")
    spots = spark.createDataFrame([(0.25, 0.25), (0.5, 0.5), (0.05, 0.5)], "lat double, lon double")
    for how in ({}, {"max_cells": 1}):
        found = lookup.first_match(spots, boxes, ["name"], "lat", "lon", cell=0.05, **how).orderBy("lat").collect()
        assert [r["name"] for r in found] == [None, "z0", "wide"]


def test_nested_boxes_keep_their_order_when_covered_ones_are_dropped(spark):
    rng = random.Random(11)
    rows = []
    for i in range(120):
        y, x, size = rng.uniform(0, 1), rng.uniform(0, 1), rng.choice([0.02, 0.3, 2.0])
        rows.append((i, y - size, y + size, x - size, x + size, f"z{i}"))
    rng.shuffle(rows)
    boxes = spark.createDataFrame(rows, "priority int, lat_from double, lat_to double, lon_from double, lon_to double, name string")
    points = points_around(rows, extra=400)
    spots = spark.createDataFrame(points, "lat double, lon double")
    expected = sorted((str(p), first(sorted(rows), *p, False) or "") for p in points)
    for how in ({}, {"max_cells": 1}):
        found = lookup.first_match(spots, boxes, ["name"], "lat", "lon", cell=0.1, **how).collect()
        assert sorted((str((r["lat"], r["lon"])), r["name"] or "") for r in found) == expected


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_plan_neither_loops_nor_runs_python_nor_shuffles_points(spark, sf):
    trips = fx.read_table(spark, sf, "lineitem").select(
        (F.col("l_quantity") + 40.0).alias("lat"), (F.col("l_tax") - 74.0).alias("lon")
    )
    plan = plan_of(lookup.first_match(trips, lookup.zone_table(spark), ["zip"], "lat", "lon"))
    assert "BroadcastHashJoin" in plan
    for bad in ("NestedLoop", "CartesianProduct", "Python", "BatchEval"):
        assert bad not in plan
    fact_side = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in fact_side
    large = plan_of(lookup.first_match(trips, lookup.zone_table(spark), ["zip"], "lat", "lon", max_cells=1))
    assert "NestedLoop" not in large and "CartesianProduct" not in large


def test_salted_join_equals_a_plain_join_under_skew(spark):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        plain = sorted(map(str, fact.join(dim, ["k"], how).select("k", "id", "v").collect()))
        salted = joins.salted_join(fact, dim, ["k"], how, salts=5).select("k", "id", "v").collect()
        assert sorted(map(str, salted)) == plain


def test_only_hot_keys_are_repeated(spark):
    fact = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), "id")
    hot = joins.hot_keys(fact, ["k"])
    assert hot == [spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]]
    dim = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = joins.salted_join(fact, dim, ["k"], "inner", salts=5)
    assert joined.count() == fact.count()
    assert joins.hot_keys(fact.filter("k != 7"), ["k"]) == [] and joins.hot_keys(fact.limit(0), ["k"]) == []
    spread = joins.spread(dim, joins.is_hot([F.col("k")], hot), 5)
    assert spread.count() == 5000 + 4


def test_equal_rows_are_spread_over_salts(spark):
    copies = spark.range(800, numPartitions=8).select(F.lit(1).alias("k"))
    dim = spark.createDataFrame([(1, "v")], "k int, v string")
    salted = joins.salted_join(copies, dim, ["k"], salts=8)
    assert salted.count() == 800


def test_unmatched_area_gets_the_default_income(spark):
    fact = spark.createDataFrame([("10001",), ("99999",)], "pickup_zip string")
    incomes = spark.createDataFrame([("10001", 80000.0)], "zip string, median_income double")
    for rows in (10, 0):
        found = {r["pickup_zip"]: (r["median_income"], r["income_category"]) for r in enrich.attach_income(fact, incomes, max_rows=rows).collect()}
        assert found == {"10001": (80000.0, "high"), "99999": (60000.0, "medium")}


def test_census_codes_that_lost_their_zero(spark):
    rows = [("1001", "50000"), ("10001", "60000"), ("10001", "61001"), ("11", "-"), ("20001", "70000"), ("10002", "0")]
    census = spark.createDataFrame(rows, "ZIP string, income_text string")
    assert {tuple(r) for r in enrich.income_by_zip(census).collect()} == {("01001", 50000.0), ("10001", 60501.0)}
    assert {tuple(r) for r in enrich.income_by_zip(census, pad_first=True).collect()} == {("10001", 60501.0)}


def brute_pairs(left, right, tol, k):
    found = []
    for v, name in left:
        near = sorted((abs(w - v), w, key) for w, key in right if abs(w - v) < tol)[:k]
        if near:
            found.append((v, name, [(w, key) for _, w, key in near]))
    return sorted(found)


@pytest.mark.parametrize("rows_per_part", [10_000_000, 40, 7])
@pytest.mark.parametrize("shape", ["continuous", "hot", "sparse", "one_sided"])
def test_band_pairs_equal_brute_force(spark, shape, rows_per_part):
    rng = random.Random(7)
    draw = {
        "continuous": lambda: rng.uniform(0, 3),
        "hot": lambda: 1.25 if rng.random() < 0.4 else round(rng.uniform(0, 3), 1),
        "sparse": lambda: rng.uniform(0, 400),
        "one_sided": lambda: rng.uniform(0, 1),
    }[shape]
    left = [(draw(), f"l{i}") for i in range(150)]
    right = [(draw() + (1.0 if shape == "one_sided" else 0.0), f"r{i:03}") for i in range(200)]
    ldf = spark.createDataFrame(left + [(None, "none")], "x double, name string").repartition(4)
    rdf = spark.createDataFrame(right, "x double, name string").repartition(3)
    found = nearest_in_band(ldf, rdf, "x", ["name"], ["name"], tol=0.1, k=5, rows_per_part=rows_per_part).collect()
    mine = sorted((r["x"], r["name"], [(p["x"], p["name"]) for p in r["partners"]]) for r in found)
    assert mine == brute_pairs(left, right, 0.1, 5)


def test_band_plan_has_no_nested_loop(spark):
    side = spark.range(1000).select((F.col("id") / 10.0).alias("x"), F.col("id").cast("string").alias("name"))
    plan = plan_of(nearest_in_band(side, side, "x", ["name"], ["name"], rows_per_part=300))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Join" not in plan and "Python" not in plan
    assert plan.count("WindowGroupLimit") >= 2  # edges are cut before they are sent


def test_band_parts_are_bounded_where_many_rows_share_a_value(spark, monkeypatch):
    sizes = []

    def watched(df, label):
        table = session.written(df, label)
        sizes.extend(r["count"] for r in table.groupBy("_part").count().collect())
        return table

    monkeypatch.setattr(band, "written", watched)
    left = spark.range(40_000, numPartitions=8).select(F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id") / 1000).alias("x"), "id")
    right = spark.range(2_000).select((F.col("id") / 50).alias("x"), F.col("id").cast("string").alias("name"))
    pairs = nearest_in_band(left, right, "x", ["name"], ["name"], rows_per_part=2_000).select("id", F.explode("partners").alias("p"))
    assert len(sizes) >= 15 and max(sizes) < 3 * 2_000
    assert pairs.filter("id % 3 > 0").groupBy("id").agg(F.collect_list("p.x").alias("xs")).select("xs").distinct().collect()[0]["xs"] == [5.0, 4.98, 5.02, 4.96, 5.04]


def test_result_does_not_depend_on_partitioning(spark, sf):
    trips = fx.valid_trips(spark, sf)
    zones = lookup.zone_table(spark)
    tables = [
        lookup.first_match(trips.repartition(n), zones, ["zip"]).groupBy("zip").count().orderBy("zip").collect() for n in (1, 16)
    ]
    assert tables[0] == tables[1]


def test_one_wide_box_does_not_crowd_the_small_ones(spark):
    rng = random.Random(12)
    rows = [(i, y, y + 0.01, x, x + 0.01, f"z{i}") for i in range(3000) for y, x in [(rng.uniform(40, 41), rng.uniform(-75, -74))]]
    rows.append((3000, -90.0, 90.0, -180.0, 180.0, "world"))
    boxes = spark.createDataFrame(rows, "priority int, lat_from double, lat_to double, lon_from double, lon_to double, name string")
    points = points_around(rows[::300], extra=200)
    spots = spark.createDataFrame(points, "lat double, lon double")
    expected = sorted((str(p), first(rows, *p, False) or "") for p in points)
    for how in ({}, {"max_cells": 1}):
        found = lookup.first_match(spots, boxes, ["name"], "lat", "lon", **how).collect()
        assert sorted((str((r["lat"], r["lon"])), r["name"] or "") for r in found) == expected
    assert most_in_a_cell(rows) < 20


def most_in_a_cell(rows, cell=0.02):
    table = lookup._cells_in_driver(np.array([r[:5] for r in rows]), cell)
    return max(map(len, table.column("boxes").to_pylist()))


def crowd(n, span, seed=13):
    rng = random.Random(seed)
    corners = [(40 + rng.uniform(0, span), -74 + rng.uniform(0, span)) for _ in range(n)]
    order = rng.sample(range(n), n)
    return [(order[i], y, y + 0.01, x, x + 0.01, f"z{i}") for i, (y, x) in enumerate(corners)]


BOXES = "priority int, lat_from double, lat_to double, lon_from double, lon_to double, name string"


@pytest.mark.parametrize("how", [{}, {"max_cells": 1}, {"by_tables": True}])
def test_crowded_boxes_are_split_into_finer_cells(spark, monkeypatch, how):
    rows = crowd(1500, 0.009)
    how = dict(how)
    if how.pop("by_tables", False):
        monkeypatch.setattr(lookup, "MAX_LOCAL", 10)
    points = points_around(rows[::100], extra=300)
    spots = spark.createDataFrame(points, "lat double, lon double").repartition(4)
    expected = sorted((str(p), first(sorted(rows), *p, False) or "") for p in points)
    found = lookup.first_match(spots, spark.createDataFrame(rows, BOXES), ["name"], "lat", "lon", **how).collect()
    assert sorted((str((r["lat"], r["lon"])), r["name"] or "") for r in found) == expected


def test_20000_crowded_boxes_cost_as_much_as_spread_ones():
    assert most_in_a_cell(crowd(20_000, 0.009)) <= lookup.CROWD
    assert most_in_a_cell(crowd(20_000, 40.0)) <= lookup.CROWD
    equal = lookup._cells_in_driver(np.array([r[:5] for r in crowd(20_000, 1e-7)]), 0.02)  # but for their last digits
    assert len(equal.column("boxes").combine_chunks().flatten()) < 40 * 20_000  # splitting stops where it does not help


def test_hot_keys_are_found_however_many_there_are(spark):
    # 99 keys of a hundredth each, and single rows for the rest
    fact = spark.range(100_000, numPartitions=7).select(F.when(F.col("id") % 100 < 99, F.col("id") % 100).otherwise(F.col("id") + 1000).alias("k"))
    keys = {r["k"]: r["h"] for r in fact.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    hot = joins.hot_keys(fact, ["k"])
    assert {keys[k] for k in range(99)} <= set(hot) and len(hot) == 99
    with pytest.raises(ValueError):
        joins.hot_keys(fact, ["k"], 0.001)


def test_null_and_differently_typed_keys(spark):
    fact = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).cast("int").alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (5_000_000_000, "c"), (None, "d")], "k bigint, v string")
    assert len(joins.hot_keys(fact, ["k"])) == 3  # null among them
    for how in ("left", "inner"):
        plain = sorted(map(str, fact.join(dim, ["k"], how).select("k", "id", "v").collect()))
        assert sorted(map(str, joins.salted_join(fact, dim, ["k"], how, salts=5).select("k", "id", "v").collect())) == plain


def test_broadcast_goes_by_bytes_too(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    rows, size = joins.measured(wide)
    assert rows == 100 and 100_000 < size < 130_000
    assert joins.fits(wide) and not joins.fits(wide, max_bytes=50_000) and not joins.fits(wide, max_rows=99)
