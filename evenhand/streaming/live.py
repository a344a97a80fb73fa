"""Continuous intake and live counters over a stream of trips."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from evenhand.operators.joins import one_row
from evenhand.operators.lookup import borough_of


def stream_files(
    spark: SparkSession, folder: str, schema, kind: str = "json", pattern: str | None = None, per_batch: int | None = None
) -> DataFrame:
    """New files of a folder as a stream; a glob may name several folders or a single file."""
    reader = spark.readStream.format(kind).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def _schedule(writer, every: str | None):
    """All that is there now and then stop, or a batch per interval until stopped."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def write_json_lines(
    trips: DataFrame, path: str, checkpoint: str, rows_per_file: int = 1000, every: str | None = None, compression: str = "none"
) -> StreamingQuery:
    """Intake to JSON-lines files of limited length.

    Offsets are kept with the checkpoint and files count only once their batch is complete, so a restart
    neither loses nor repeats a message. A message is about 520 bytes of text; ``compression`` names a codec of Spark's
    for the files, which readers tell by their ending. Runs with and without it may share a folder.
    """
    writer = trips.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", False).option("compression", compression)
    return _schedule(writer.outputMode("append"), every).start()


def totals(trips: DataFrame) -> DataFrame:
    """Messages, fares and distances so far. No watermark: every message counts, however old."""
    return trips.groupBy().agg(
        F.count(F.lit(1)).alias("messages_consumed"),
        F.round(F.coalesce(F.sum("fare_amount"), F.lit(0.0)), 2).alias("fare_sum"),
        F.round(F.coalesce(F.sum("trip_distance"), F.lit(0.0)), 2).alias("distance_sum"),
    )


def borough_counts(trips: DataFrame) -> DataFrame:
    """Messages so far by borough; a missing or zero position counts as "Unknown"."""
    return trips.groupBy(borough_of("pickup_latitude", "pickup_longitude").alias("borough")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def rate(trips: DataFrame, time: str, width: str = "1 second", delay: str = "10 seconds") -> DataFrame:
    """Messages per window of intake time.

    A window that ends ``delay`` before the newest time of an earlier batch is closed: its row is final, its state goes,
    and later messages for it are dropped. In append mode a window is written when it closes, in update mode whenever
    it changes.
    """
    counted = trips.withWatermark(time, delay).groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("messages"))
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counted.select(
        F.col("window.start").alias("window_start"),
        "messages",
        F.round(F.col("messages") / seconds, 1).alias("messages_per_sec"),
    )


SLOTS = 16
COMPACT = 64
POINTER = "run string, started double, batch long, base long"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small rows about a live table, or none where nothing was written yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _row(spark: SparkSession, schema: str, *values) -> DataFrame:
    """One row made by Spark itself, in one task."""
    kinds = [column.split() for column in schema.split(", ")]
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, kinds)])


def _run(spark: SparkSession, path: str, checkpoint: str) -> tuple[str, float]:
    """The run that a checkpoint belongs to. A restart goes on with its run; a new checkpoint starts a new one."""
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    started = _table(spark, f"{path}/runs", "run string, started double").filter(F.col("run") == name).agg(F.max("started")).first()[0]
    if started is None:
        started = time.time()
        _row(spark, "run string, started double", name, started).write.mode("append").parquet(f"{path}/runs")
    return name, started


def reset(spark: SparkSession, path: str) -> str:
    """Start the counters of a live table over: readers see no rows until a query publishes with the new checkpoint.

    Returns that checkpoint's path. A stream read with it begins where its source says; old runs stay where they are.
    """
    checkpoint = f"{path}/checkpoints/{uuid.uuid4().hex}"
    _run(spark, path, checkpoint)
    return checkpoint


def _point(spark: SparkSession, path: str, run: tuple[str, float], batch: int, base: int) -> None:
    """Tell readers about a batch that is wholly written. Pointers take turns in a fixed number of places."""
    row = _row(spark, POINTER, *run, batch, base)
    row.write.mode("overwrite").parquet(f"{path}/pointers/{run[0]}/place={batch % SLOTS}")


def _pointer(spark: SparkSession, path: str):
    """The newest run, with its newest batch if it has one."""
    run = _table(spark, f"{path}/runs", "run string, started double").orderBy(F.desc("started")).first()
    if run is None:
        return None, None
    places = _table(spark, f"{path}/pointers/{run['run']}", POINTER)
    return run["run"], places.orderBy(F.desc("batch")).first()


def publish(
    table: DataFrame, path: str, checkpoint: str, mode: str = "complete", every: str | None = None, keys: Sequence[str] = ()
) -> StreamingQuery:
    """Write a live table after each batch: all of it in complete mode, the changed rows in update mode.

    Readers follow a pointer that is written after its batch, within the newest run. Complete tables take turns in a
    fixed number of folders. Changed rows are all kept; with ``keys`` they are merged from time to time, so that
    readers open at most COMPACT folders.
    """
    spark = table.sparkSession
    run = _run(spark, path, checkpoint)
    folder = f"{path}/data/{run[0]}"

    def store(batch: DataFrame, number: int) -> None:
        place, base = (number % SLOTS if mode == "complete" else number), 0
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/batch={place}")
        if mode != "complete" and keys:
            base = number - number % COMPACT
            if number and number == base:
                _merged(spark, folder, keys, number - COMPACT, number).write.mode("overwrite").parquet(f"{folder}/merged={number}")
        _point(spark, path, run, number, base)

    writer = table.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _schedule(writer.foreachBatch(store), every).start()


def _merged(spark: SparkSession, folder: str, keys: Sequence[str], base: int, last: int) -> DataFrame:
    """Per key the row of its latest batch: what was merged up to ``base`` and the batches after it."""
    paths = [f"{folder}/batch={n}" for n in range(base + 1 if base else 0, last + 1)]
    batches = spark.read.parquet(*paths, *([f"{folder}/merged={base}"] if base else []))
    values = [c for c in batches.columns if c not in (*keys, "batch")]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*values, "batch"), "batch").alias("row"))
    return newest.select(*keys, "row.*")


def published(spark: SparkSession, path: str) -> DataFrame:
    """The latest complete state of the newest run; no rows while that run has no batch."""
    run, pointer = _pointer(spark, path)
    if pointer is None:
        return spark.read.parquet(f"{path}/data/*/batch=*").drop("batch").limit(0)
    return spark.read.parquet(f"{path}/data/{run}/batch={pointer['batch'] % SLOTS}").drop("batch")


def updated(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """State of the newest run written in update mode: per key the row of its latest batch."""
    run, pointer = _pointer(spark, path)
    if pointer is None:
        return spark.read.parquet(f"{path}/data/*/batch=*").drop("batch").limit(0)
    return _merged(spark, f"{path}/data/{run}", keys, pointer["base"], pointer["batch"]).drop("batch")


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
BUCKETS = 16


def keep_latest(
    trips: DataFrame, order: Sequence[str], checkpoint: str, n: int = 20, buckets: int = BUCKETS, every: str | None = None
) -> StreamingQuery:
    """Keep the ``n`` latest rows by ``order`` in the query's own state, where ``latest`` reads them.

    Every task cuts its rows to their own latest ``n`` before they are sent, and a bucket by row hash keeps at most
    ``n`` rows, so neither what is sent nor the state grows with the messages. Restarts go by Spark's checkpoint.
    A null comes before all values, a NaN after them.
    """
    schema, names = trips.schema, trips.columns

    # Nested, so that executors need no copy of this package.
    def rank(values: Sequence) -> tuple:
        return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in values)

    def first(table):
        """Places of the ``n`` latest rows, of equal ones those that come first. Columns are sorted as they are, not cell by cell."""
        import heapq

        import pyarrow as pa
        import pyarrow.compute as pc

        kinds = pa.types
        plain = (kinds.is_integer, kinds.is_floating, kinds.is_boolean, kinds.is_string, kinds.is_large_string, kinds.is_binary,
                 kinds.is_large_binary, kinds.is_timestamp, kinds.is_date, kinds.is_decimal)
        columns = [table.column(c) for c in order]
        if not all(any(is_kind(column.type) for is_kind in plain) for column in columns):
            ranks = [rank(row) for row in zip(*[column.to_pylist() for column in columns])]
            return pa.array(heapq.nlargest(n, range(len(ranks)), key=ranks.__getitem__), pa.int64())
        keys = []
        for column in columns:
            if kinds.is_floating(column.type):  # Arrow would put a NaN beside the nulls
                odd = pc.fill_null(pc.is_nan(column), False)
                keys += [odd, pc.if_else(odd, pa.scalar(0.0, column.type), column)]
            else:
                keys.append(column)
        labels = [str(i) for i in range(len(keys))]
        return pc.sort_indices(pa.table(keys, names=labels), sort_keys=[(label, "descending") for label in labels])[:n]

    def cut(batches):
        import pyarrow as pa

        best = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if best is None else [*best.to_batches(), batch])
            best = table.take(first(table)).combine_chunks()
        if best is not None:
            yield from best.to_batches()

    places = [names.index(c) for c in order]

    class Latest(StatefulProcessor):
        def init(self, handle) -> None:
            self.rows = handle.getListState("latest", schema)

        def handleInputRows(self, key, rows, timerValues):
            kept = [tuple(row) for row in self.rows.get()] if self.rows.exists() else []
            kept += [tuple(row[name] for name in names) for row in rows]
            kept = sorted(kept, key=lambda row: rank([row[at] for at in places]), reverse=True)[:n]
            self.rows.put(kept)
            yield Row(bucket=key[0], kept=len(kept))

        def close(self) -> None:
            pass

    spark = trips.sparkSession
    few = trips.mapInArrow(cut, schema).withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))
    kept = few.groupBy("bucket").transformWithState(Latest(), "bucket int, kept int", "Update", "None")
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)  # a query takes its settings along when it starts
    try:
        writer = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        return _schedule(writer, every).start()
    finally:
        spark.conf.set(STATE_STORE[0], before)


def latest(spark: SparkSession, checkpoint: str, order: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` latest rows of the last complete batch of ``keep_latest``, latest first."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load()
    return state.select("list_element.*").orderBy(*[F.desc(c) for c in order]).limit(n)


def append_rows(table: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Final rows, as those of windows that have closed, to Parquet files; each row is written once, restarts included."""
    writer = table.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return _schedule(writer, every).start()


def recent_view(trips: DataFrame, *more: str) -> DataFrame:
    """The fields a live feed shows of a trip, and more where an order needs them."""
    return trips.select(
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("fare_amount").alias("fare"),
        F.col("trip_distance").alias("distance"),
        F.col("passenger_count").alias("passengers"),
        borough_of("pickup_latitude", "pickup_longitude").alias("borough"),
        *more,
    )


def snapshot(
    spark: SparkSession, totals_path: str, boroughs_path: str, latest_trips: DataFrame, rate_path: str | None = None, shown: int = 5
) -> DataFrame:
    """One row of all live numbers: totals, rate of the last full window, count per borough and latest trips.

    The newest window may still fill, so the one before it is shown. Without a rate table the rate is null.
    """
    parts = published(spark, totals_path).select("messages_consumed", "fare_sum", "distance_sum")
    counts = published(spark, boroughs_path).agg(
        F.map_from_entries(F.collect_list(F.struct("borough", "trips"))).alias("borough_counts")
    )
    trips = latest_trips.drop("ingestion_timestamp")
    order = F.sort_array(F.collect_list(F.struct(*trips.columns)), asc=False)
    feed = trips.agg(F.slice(order, 1, shown).alias("recent_trips"))
    if rate_path is None:
        rates = spark.range(1).select(F.lit(None).cast("double").alias("messages_per_sec"))
    else:
        newest = updated(spark, rate_path, ["window_start"]).orderBy(F.desc("window_start")).limit(2)
        oldest = F.min(F.struct("window_start", "messages_per_sec"))
        rates = newest.agg(F.when(F.count(F.lit(1)) > 1, oldest["messages_per_sec"]).alias("messages_per_sec"))
    return one_row(parts, rates, counts, feed)


def drain(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself, and raise its error if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
