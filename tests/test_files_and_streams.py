"""Sources, sinks, catalog, streams over several files, and the staged audit."""

from __future__ import annotations

import datetime
import gzip
import itertools
import json
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evenhand import schemas, session
from evenhand.operators import cleaning, models, sampling
from evenhand.plans import audit
from checks import fixture as fx
from checks.queries import QUERIES
from evenhand.sources import catalog, files, messages
from evenhand.streaming import live

HEADER = ",".join(schemas.RAW_TRIPS.fieldNames())
GOOD = "1,2016-01-04 08:00:00,2016-01-04 08:30:00,1,5.0,-74.0,40.7,1,N,-73.9,40.8,1,20.0,0.5,0.5,3.0,0.0,0.3,24.3"


def write(path: Path, *lines: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_csv_cells_that_do_not_fit_become_null(spark, tmp_path):
    bad = GOOD.replace("20.0", "n/a").replace("2016-01-04 08:30:00", "later")
    empty = GOOD.replace(",N,", ",,")
    path = write(tmp_path / "a.csv", GOOD, bad, empty)
    first, second, third = files.read_trips_csv(spark, path).collect()
    assert first["fare_amount"] == 20.0 and first["tpep_pickup_datetime"].hour == 8
    assert second["fare_amount"] is None and second["tpep_dropoff_datetime"] is None and second["VendorID"] == 1
    assert third["store_and_fwd_flag"] is None


def test_faulty_lines_are_told_from_empty_cells(spark, tmp_path):
    rows = [GOOD, GOOD.replace("20.0", "n/a").replace("2016-01-04 08:30:00", "later"), GOOD.replace(",N,", ",,"), GOOD + ",9", GOOD[:-5]]
    path = write(tmp_path / "a.csv", *rows)
    table = files.read_trips_checked(spark, path).withColumn("lost", files.fault_fields())
    found = [(r["faulty_line"], r["lost"], r["VendorID"]) for r in table.collect()]
    assert found == [
        (None, None, 1), (rows[1], ["tpep_dropoff_datetime", "fare_amount"], 1), (None, None, 1), (rows[3], [], 1), (rows[4], [], 1),
    ]
    plain = files.read_trips_csv(spark, path)
    assert table.select(plain.columns).collect() == plain.collect()
    # asked for one good column alone, the fault shows as well
    assert [r[1] is None for r in files.read_trips_checked(spark, path).select("VendorID", "faulty_line").collect()] == [True, False, True, False, False]


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("\n".join([HEADER.replace("VendorID,tpep_pickup_datetime", "tpep_pickup_datetime,VendorID"), GOOD]) + "\n")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_trips_checked(spark, str(path)).collect()
    assert files.read_trips_checked(spark, str(path), check_header=False).count() == 1


def test_audit_reads_the_raw_files_once(spark, tmp_path):
    write(tmp_path / "raw" / "a.csv", GOOD, GOOD.replace("20.0", "n/a"), GOOD.replace(",0.5,0.5,", ",x,0.5,"), GOOD.replace("-74.0,", "0.0,"))
    paths = audit.Paths(f"{tmp_path}/raw", "", f"{tmp_path}/out")
    scans = []
    before = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    funnel = audit.clean(spark, paths).first().asDict()
    store = spark._jsparkSession.sharedState().statusStore()
    for at in range(before, store.executionsList().size()):
        scans.append(store.executionsList().apply(at).physicalPlanDescription().count("Scan csv"))
    assert sum(scans) <= 2  # the tree and its details name the one scan
    assert funnel == {"initial_rows": 4, "after_nulls": 3, "after_zero_gps": 2, "after_outliers": 2, "faulty_rows": 2, "removed_pct": 50.0}
    assert audit.cleaned_trips(spark, paths).count() == 2
    faults = {r["faulty_line"]: r["lost_fields"] for r in audit.faulty_lines(spark, paths).collect()}
    assert sorted(map(tuple, faults.values())) == [("extra",), ("fare_amount",)]
    write(tmp_path / "raw2" / "a.csv", GOOD)
    paths = audit.Paths(f"{tmp_path}/raw2", "", f"{tmp_path}/out2")
    assert audit.clean(spark, paths).first()["faulty_rows"] == 0 and audit.faulty_lines(spark, paths).count() == 0


def test_several_files_by_glob_and_by_head(spark, tmp_path):
    paths = [write(tmp_path / f"t_{i}.csv", *[GOOD] * 5) for i in range(3)]
    assert files.read_trips_csv(spark, str(tmp_path / "t_*.csv")).count() == 15
    assert files.read_heads(spark, paths, 2).count() == 6
    assert files.read_heads(spark, paths, 50).count() == 15


def test_census_codes_and_inference(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("ZIP,Households Median Income (Dollars)\n01001,50000\n10001,-\n")
    rows = files.read_census_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("1001", "50000"), ("10001", "-")]
    assert dict(files.read_inferred_csv(spark, str(path)).dtypes)["ZIP"] == "int"


def test_file_counts_of_sinks(spark, tmp_path):
    df = spark.range(100, numPartitions=8)
    files.write_small_csv(df, f"{tmp_path}/one")
    files.write_rows_csv(df, f"{tmp_path}/few", 3)
    files.write_parquet(df, f"{tmp_path}/parquet", 2)
    files.write_parquet(df.limit(5), f"{tmp_path}/parquet", 2)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    assert len(list((tmp_path / "few").glob("part-*.csv"))) == 3
    assert files.read_parquet(spark, f"{tmp_path}/parquet").count() == 5
    assert all(".snappy." in p.name for p in (tmp_path / "parquet").glob("part-*"))
    assert files.read_result_csv(spark, f"{tmp_path}/few").count() == 100


def test_tables_and_views(spark, sf, tmp_path):
    files.write_parquet(cleaning.clean_trips(fx.raw_trips(spark, sf)), f"{tmp_path}/clean")
    write(tmp_path / "raw" / "a.csv", GOOD, GOOD)
    places = {name: f"{tmp_path}/{name}" for name in catalog.TABLES}
    catalog.create_tables(spark, {**places, "taxi_trips_raw": f"{tmp_path}/raw", "taxi_trips_cleaned": f"{tmp_path}/clean"}, "audit_test")
    try:
        names = {r["tableName"] for r in catalog.list_tables(spark).filter("not isTemporary").collect()}
        assert names == set(catalog.TABLES)
        assert spark.table("taxi_trips_raw").count() == 2
        assert spark.sql("SELECT max(fare_amount) FROM taxi_trips_raw").first()[0] == 20.0
        assert spark.table("taxi_trips_cleaned").schema.fieldNames() == schemas.CLEAN_TRIPS.fieldNames()
        catalog.create_table(spark, "taxi_trips_raw", f"{tmp_path}/raw")
        assert spark.table("taxi_trips_raw").count() == 2
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE audit_test CASCADE")


def test_messages_keep_nulls_and_survive_bad_values(spark):
    row = spark.createDataFrame([(1, None, "2016-01-04 08:00:00")], "VendorID int, fare_amount double, tpep_pickup_datetime string")
    sent = messages.encode(row)
    assert sent.first()["key"] == "2016-01-04 08:00:00"
    assert json.loads(sent.first()["value"])["fare_amount"] is None
    broken = sent.select("key", F.lit("{no json").alias("value"))
    assert messages.decode(broken).first()["VendorID"] is None
    assert messages.decode(sent, ["VendorID"]).first().asDict() == {"VendorID": 1}
    options = messages.kafka_options("host:9092", "trips", "group", from_start=False)
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "group"


@pytest.fixture()
def message_files(spark, sf, tmp_path):
    """Trips as JSON lines in six files."""
    folder = f"{tmp_path}/in"
    cleaning.stamp_ingestion(fx.raw_trips(spark, sf).drop("h")).repartition(6, "trip_distance").write.json(folder)
    return folder


def stream(spark, folder):
    return live.stream_files(spark, folder, schemas.MESSAGE, "json", per_batch=1)


def same(mine, theirs):
    return sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect()))


def test_live_tables_equal_batch_tables_over_several_batches(spark, message_files, tmp_path):
    batch = spark.read.schema(schemas.MESSAGE).json(message_files)
    for name, table in {"totals": live.totals, "boroughs": live.borough_counts}.items():
        live.drain(live.publish(table(stream(spark, message_files)), f"{tmp_path}/{name}", f"{tmp_path}/{name}-c"))
        published = live.published(spark, f"{tmp_path}/{name}")
        assert same(published.select(sorted(published.columns)), table(batch).select(sorted(published.columns)))
    order = ["pickup", "fare", "distance", "passengers"]
    live.drain(live.keep_latest(live.recent_view(stream(spark, message_files)), order, f"{tmp_path}/last-c"))
    expected = live.recent_view(batch).orderBy(*[F.desc(c) for c in order]).limit(20)
    latest = live.latest(spark, f"{tmp_path}/last-c", order)
    assert same(latest.select(expected.columns), expected)
    row = live.snapshot(spark, f"{tmp_path}/totals", f"{tmp_path}/boroughs", latest).first()
    assert row["messages_consumed"] == batch.count() == sum(row["borough_counts"].values())
    assert len(row["recent_trips"]) == 5
    assert row["recent_trips"][0]["pickup"] == batch.agg(F.max("tpep_pickup_datetime")).first()[0]


def test_restart_neither_loses_nor_repeats_and_a_new_checkpoint_starts_over(spark, message_files, tmp_path):
    out, check = f"{tmp_path}/totals", f"{tmp_path}/check"
    live.drain(live.publish(live.totals(stream(spark, message_files)), out, check))
    before = live.published(spark, out).first()["messages_consumed"]
    extra = spark.read.schema(schemas.MESSAGE).json(message_files).limit(10)
    extra.coalesce(1).write.mode("append").json(message_files)
    live.drain(live.publish(live.totals(stream(spark, message_files)), out, check))
    assert live.published(spark, out).first()["messages_consumed"] == before + 10
    live.drain(live.publish(live.totals(stream(spark, message_files)), f"{tmp_path}/new", f"{tmp_path}/new-check"))
    assert live.published(spark, f"{tmp_path}/new").first()["messages_consumed"] == before + 10


def test_json_lines_are_cut_and_complete(spark, message_files, tmp_path):
    query = live.write_json_lines(stream(spark, message_files), f"{tmp_path}/out", f"{tmp_path}/check", rows_per_file=500)
    live.drain(query)
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "out").glob("part-*.json")]
    assert max(sizes) <= 500 and sum(sizes) == spark.read.schema(schemas.MESSAGE).json(message_files).count()


def test_compressed_json_lines_hold_the_same_messages(spark, message_files, tmp_path):
    for name, codec in (("plain", "none"), ("small", "gzip"), ("both", "none"), ("both", "gzip")):
        check = f"{tmp_path}/{name}-{codec}-check" if name != "both" else f"{tmp_path}/both-check"
        live.drain(live.write_json_lines(stream(spark, message_files), f"{tmp_path}/{name}", check, rows_per_file=500, compression=codec))
    plain, small, both = (spark.read.schema(schemas.MESSAGE).json(f"{tmp_path}/{name}") for name in ("plain", "small", "both"))
    assert same(small, plain) and same(both, plain)
    sizes = [len(gzip.decompress(p.read_bytes()).splitlines()) for p in (tmp_path / "small").glob("part-*.json.gz")]
    assert max(sizes) <= 500 and sum(sizes) == plain.count()


def intake_size(spark, sf, name: str, label: str) -> tuple[int, int]:
    """Messages and bytes that a query's intake leaves on disk."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob(f"evenhand-{label}-*"))
    n = QUERIES[name](spark, sf).first()["n"]
    (made,) = set(shared.glob(f"evenhand-{label}-*")) - before
    return n, sum(p.stat().st_size for p in (made / "out").glob("part-*"))


def test_the_restarted_intake_takes_a_fraction_of_the_text_on_disk(spark, sf):
    n, size = intake_size(spark, sf, "stream_restart", "restart")
    assert n == spark.read.parquet(f"{sf}/lineitem.parquet").count() and size < 100 * n


def test_the_intake_roundtrip_takes_a_fraction_of_the_text_on_disk(spark, sf):
    n, size = intake_size(spark, sf, "stream_jsonl_roundtrip", "jsonl")
    assert n == spark.read.parquet(f"{sf}/lineitem.parquet").count() and size < 100 * n


def test_rate_counts_every_message_per_window(spark, message_files, tmp_path):
    def timed(df):
        return df.withColumn("t", F.col("tpep_pickup_datetime").cast("timestamp"))

    # ship dates span years and come in any order, so nothing may count as late
    rates = live.rate(timed(stream(spark, message_files)), "t", "1 minute", "20000 days")
    live.drain(live.publish(rates, f"{tmp_path}/rate", f"{tmp_path}/rate-c", "update"))
    found = live.updated(spark, f"{tmp_path}/rate", ["window_start"])
    batch = timed(spark.read.schema(schemas.MESSAGE).json(message_files))
    expected = batch.groupBy(F.date_trunc("minute", "t").alias("window_start")).agg(F.count(F.lit(1)).alias("messages"))
    assert same(found.select("window_start", "messages"), expected)


def test_latest_rows_outlive_a_restart_and_odd_values(spark, tmp_path):
    def rows(*values):
        spark.createDataFrame(values, "t timestamp, x double, name string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        trips = spark.readStream.schema("t timestamp, x double, name string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        live.drain(live.keep_latest(trips, ["x", "name"], f"{tmp_path}/check", n=4, buckets=2))
        return [(r["x"], r["name"]) for r in live.latest(spark, f"{tmp_path}/check", ["x", "name"], 4).collect()]

    rows((None, 1.0, "a"), (None, None, "b"), (None, 3.0, "c"))
    assert run() == [(3.0, "c"), (1.0, "a"), (None, "b")]
    rows((None, 2.0, "d"), (None, 2.0, None), (None, float("inf"), "e"))
    rows((None, -5.0, "f"), (None, 2.0, "g"))
    assert run() == [(float("inf"), "e"), (3.0, "c"), (2.0, "g"), (2.0, "d")]
    rows((None, float("nan"), "h"))
    kept = run()
    assert str(kept[0]) == "(nan, 'h')" and kept[1:] == [(float("inf"), "e"), (3.0, "c"), (2.0, "g")]
    assert str(run()) == str(kept)  # a run without new files changes nothing
    state = spark.read.format("statestore").option("path", f"{tmp_path}/check").option("stateVarName", "latest").load()
    assert state.count() <= 2 * 4


def test_latest_rows_take_four_batches_however_many_files_there_are(spark, sf, tmp_path):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").limit(400)
    lines.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("evenhand-latest-*"))
    found = QUERIES["stream_latest_restarted"](spark, str(tmp_path)).collect()
    (made,) = set(shared.glob("evenhand-latest-*")) - before
    assert len([*(made / "check" / "commits").glob("[0-9]*")]) == 4
    assert len([*(made / "lines").glob("part-*")]) > 4
    trips = live.recent_view(fx.trips_from_lines(lines), "h")
    assert found == trips.orderBy(*[F.desc(c) for c in ("pickup", "h", "fare", "distance")]).limit(20).collect()


def test_latest_rows_by_columns_of_several_types(spark, tmp_path):
    schema = "x double, name string, d decimal(4,1), b boolean, at timestamp_ntz, parts array<int>"
    nan, day = float("nan"), datetime.datetime(2020, 1, 1)
    values = ((None, nan, -1.0, 1.0), (None, "a", "\u20ac", "\U0001f600"), (None, Decimal("-1.5"), Decimal("2.0")), (None, False, True), (None, day), (None, [1], [1, 2]))
    rows = [*itertools.product(*values)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/in")
    for order in (["x", "name", "d", "b", "at"], ["b", "d", "x", "at", "name"], ["parts", "x", "d", "name"]):
        check = f"{tmp_path}/{'-'.join(order)}"
        live.drain(live.keep_latest(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), order, check, n=30, buckets=3))
        places = [schema.replace(", ", " ").split()[::2].index(c) for c in order]
        ranked = sorted(([(v is not None, v != v, 0 if v is None or v != v else v) for v in (row[i] for i in places)] for row in rows), reverse=True)
        kept = [[(v is not None, v != v, 0 if v is None or v != v else v) for v in (r[c] for c in order)] for r in live.latest(spark, check, order, 30).collect()]
        assert kept == ranked[:30]


def test_closed_windows_leave_the_state_and_late_rows_are_dropped(spark, tmp_path):
    def batch(*minutes):
        rows = [(f"2024-01-01 {m // 60:02}:{m % 60:02}:30",) for m in minutes]
        spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rates = live.rate(spark.readStream.schema("t timestamp").parquet(f"{tmp_path}/in"), "t", "1 minute", "10 minutes")
        query = live.append_rows(rates, f"{tmp_path}/out", f"{tmp_path}/check")
        live.drain(query)
        states = [p["stateOperators"][0] for p in query.recentProgress]
        return states[-1]["numRowsTotal"], sum(s["numRowsDroppedByWatermark"] for s in states)

    def closed():
        return [(r["window_start"].hour * 60 + r["window_start"].minute, r["messages"]) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()]

    assert batch(*range(30), 29) == (11, 0)  # closed: all that end at 19:30 or before
    assert closed() == [(m, 1) for m in range(19)]
    open_windows, dropped = batch(5, 20, 60)  # 5 is late, 20 is not
    assert (open_windows, dropped) == (1, 1)
    assert closed() == [(m, 2 if m in (20, 29) else 1) for m in range(30)]
    for start in range(61, 400, 40):
        assert batch(*range(start, start + 40))[0] <= 12  # however long it runs


def test_interval_trigger_takes_new_files_until_it_is_stopped(spark, message_files, tmp_path):
    rows = spark.read.schema(schemas.MESSAGE).json(message_files)
    query = live.publish(live.totals(stream(spark, message_files)), f"{tmp_path}/out", f"{tmp_path}/check", every="500 milliseconds")
    try:
        for _ in range(2):
            expected, deadline = rows.count(), time.time() + 120
            while time.time() < deadline and (live.published(spark, f"{tmp_path}/out").agg(F.max("messages_consumed")).first()[0] if query.lastProgress else 0) != expected:
                time.sleep(0.5)
            assert live.published(spark, f"{tmp_path}/out").first()["messages_consumed"] == expected
            assert query.isActive
            rows.limit(25).coalesce(1).write.mode("append").json(message_files)
            rows = spark.read.schema(schemas.MESSAGE).json(message_files)
    finally:
        query.stop()
    assert not query.isActive and query.exception() is None


def test_changed_rows_are_merged_and_none_is_lost(spark, message_files, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "COMPACT", 2)
    folder = f"{tmp_path}/many"
    spark.read.schema(schemas.MESSAGE).json(message_files).repartition(7).write.json(folder)
    trips = live.stream_files(spark, folder, schemas.MESSAGE, per_batch=1)
    live.drain(live.publish(live.borough_counts(trips), f"{tmp_path}/few", f"{tmp_path}/few-c", "update", keys=["borough"]))
    assert list((tmp_path / "few").glob("data/*/merged=*"))
    found = live.updated(spark, f"{tmp_path}/few", ["borough"])
    assert same(found, live.borough_counts(spark.read.schema(schemas.MESSAGE).json(message_files)).select(found.columns))


def test_a_new_checkpoint_on_the_same_path_starts_a_new_run(spark, message_files, tmp_path):
    out, n = f"{tmp_path}/out", spark.read.schema(schemas.MESSAGE).json(message_files).count()
    folder = f"{tmp_path}/many"
    spark.read.schema(schemas.MESSAGE).json(message_files).repartition(3).write.json(folder)
    several = live.totals(live.stream_files(spark, folder, schemas.MESSAGE, per_batch=1))
    live.drain(live.publish(several, out, f"{tmp_path}/first"))
    assert live.published(spark, out).first()["messages_consumed"] == n
    few = live.totals(stream(spark, message_files).filter(F.col("passenger_count") > 5))
    live.drain(live.publish(few, out, f"{tmp_path}/second"))
    assert 0 < live.published(spark, out).first()["messages_consumed"] < n


def test_reset_empties_a_live_table(spark, message_files, tmp_path):
    out = f"{tmp_path}/out"
    live.drain(live.publish(live.totals(stream(spark, message_files)), out, f"{tmp_path}/first"))
    before = live.published(spark, out).first()
    checkpoint = live.reset(spark, out)
    assert live.published(spark, out).count() == 0
    live.drain(live.publish(live.totals(stream(spark, message_files)), out, checkpoint))
    assert live.published(spark, out).first() == before


def test_text_is_typed_on_a_stream(spark, tmp_path):
    text = ", ".join(f"{n} string" for n in schemas.RAW_TRIPS.fieldNames())
    write(tmp_path / "in" / "a.csv", GOOD, GOOD.replace("20.0", "x"))
    raw = spark.readStream.schema(text).option("header", True).csv(f"{tmp_path}/in")
    typed = cleaning.stamp_ingestion(cleaning.type_fields(raw))
    live.drain(live.write_json_lines(typed, f"{tmp_path}/out", f"{tmp_path}/check"))
    rows = spark.read.schema(schemas.MESSAGE).json(f"{tmp_path}/out").collect()
    assert sorted(r["fare_amount"] or 0.0 for r in rows) == [0.0, 20.0]
    assert all(r["passenger_count"] == 1 and r["ingestion_timestamp"].endswith("+00:00") for r in rows)


def test_shared_folder_comes_from_the_session(spark, tmp_path, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("Context", (), {"master": master})()

    assert session.shared_path(Session("hdfs://x/check/", "yarn"), "a").startswith("hdfs://x/check/evenhand-a-")
    with pytest.raises(ValueError):
        session.shared_path(Session(None, "spark://host:7077"), "a")


def test_shuffle_parts_are_fitted_only_where_nobody_chose_them():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def tuned(master, cores, **chosen):
        conf = Conf({session.SHUFFLE_PARTITIONS: "200", **chosen})
        context = type("Context", (), {"master": master, "defaultParallelism": cores})()
        return session.tune(type("Session", (), {"conf": conf, "sparkContext": context})()).conf

    assert tuned("local[8]", 8)[session.SHUFFLE_PARTITIONS] == "8"
    assert tuned("local[8]", 8, **{session.SHUFFLE_PARTITIONS: "5"})[session.SHUFFLE_PARTITIONS] == "5"
    assert tuned("yarn", 4000)[session.INITIAL_PARTITIONS] == "16000"
    assert tuned("yarn", 4000, **{session.INITIAL_PARTITIONS: "9"})[session.INITIAL_PARTITIONS] == "9"
    assert session.INITIAL_PARTITIONS not in tuned("yarn", 10)


def test_shuffle_parts_follow_the_bytes():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def frame(size, conf, master="yarn"):
        stats = type("Stats", (), {"sizeInBytes": lambda self: size})()
        plan = type("Plan", (), {"stats": lambda self: stats})()
        execution = type("Execution", (), {"optimizedPlan": lambda self: plan})()
        context = type("Context", (), {"master": master, "defaultParallelism": 1000})()
        spark = type("Session", (), {"conf": conf, "sparkContext": context})()
        return type("Frame", (), {"sparkSession": spark, "_jdf": type("J", (), {"queryExecution": lambda self: execution})()})()

    conf = Conf({session.SHUFFLE_PARTITIONS: "200"})
    assert session.fit_shuffles(frame(1 << 30, conf)) == 4000  # by cores
    assert session.fit_shuffles(frame(5 << 40, conf), frame(5 << 40, conf)) == 81920  # 128 MB each
    assert session.fit_shuffles(frame(1 << 50, conf)) == session.MAX_PARTS
    assert session.fit_shuffles(frame(1 << 30, conf)) == 4000 and conf[session.INITIAL_PARTITIONS] == "4000"
    assert session.fit_shuffles(frame(1 << 50, Conf({session.SHUFFLE_PARTITIONS: "64"}))) is None
    assert session.fit_shuffles(frame(1 << 50, Conf({session.SHUFFLE_PARTITIONS: "200", session.INITIAL_PARTITIONS: "9"}))) is None
    assert session.fit_shuffles(frame(1 << 50, Conf({session.SHUFFLE_PARTITIONS: "200"}), "local[8]")) is None


def test_audit_from_files_to_reports(spark, sf, tmp_path):
    raw, census = f"{tmp_path}/raw", f"{tmp_path}/census"
    files.write_trips_csv(fx.raw_trips(spark, sf).drop("h"), raw)
    header = "Households Median Income (Dollars)"
    files.write_rows_csv(fx.census_text(spark, sf).withColumnRenamed("income_text", header), census)
    paths = audit.Paths(raw, census, f"{tmp_path}/out")
    funnel = audit.clean(spark, paths).first()
    assert (funnel["initial_rows"], funnel["after_outliers"]) == (6000, 4378)
    profile = {r["income_category"]: r["trip_count"] for r in audit.add_income(spark, paths, 2).collect()}
    assert profile == {"high": 491, "medium": 379, "low": 246}
    metrics = audit.train(spark, paths, fraction=0.5).collect()
    assert {r["model"] for r in metrics} == {"baseline", "fair"}
    assert files.read_result_csv(spark, f"{paths.bias}/bias_summary_csv", schemas.BIAS_SUMMARY).count() == 3
    assert files.read_result_csv(spark, f"{paths.bias}/borough_bias_csv", schemas.BOROUGH_BIAS).count() == 4
    assert files.read_result_csv(spark, paths.comparison).columns == list(schemas.COMPARISON_COLUMNS)
    assert audit.detect_bias(spark, paths).count() == 3
    report = spark.read.json(f"{paths.bias}/bias_report").first()
    assert report["financial_impact"]["affected_trips_annually"] > 0
    enriched = files.read_parquet(spark, paths.enriched)
    usable = models.ml_ready(enriched, sorted({*models.FEATURE_SETS["baseline"], *models.FEATURE_SETS["fair"]}))
    assert files.read_parquet(spark, paths.predictions).count() == sampling.hash_split(usable, ["trip_id"], 0.4)[1].count()
    gains = {r["metric"] for r in audit.measure_fairness(spark, paths).collect()}
    assert gains == {"demographic_parity", "equalized_odds", "individual_fairness", "overall"}
    fairness = spark.read.json(f"{paths.fairness}/report").first()
    assert fairness["individual_fairness"]["baseline"]["comparisons"] > 0
