"""Trip-shaped inputs derived by Spark from the order tables, so that queries grow with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.fixed_values import zone_rows
from evenhand.operators import cleaning, enrich, lookup
from evenhand.operators.disparity import with_errors

MODELS = {"baseline": "predicted_fare_baseline", "fair": "predicted_fare_fair"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_number() -> Column:
    """A number that varies from line to line, the source of all derived variety."""
    return F.expr("l_orderkey * 7 + l_linenumber * 131 + l_partkey * 17 + l_suppkey * 29")


def trips_from_lines(lines: DataFrame) -> DataFrame:
    """The raw trip fields, and ``h``, from order lines. Works on a stream of lines as well."""
    pickup = F.expr("l_shipdate + (h % 86400) * INTERVAL '1' SECOND")
    numbered = lines.withColumn("h", line_number()).withColumn("tpep_pickup_datetime", pickup)
    h = F.col("h")
    fare = F.when(h % 101 != 0, F.round(F.col("l_extendedprice") / 2000.0, 2))

    def place(factor: int, span: int, origin: float) -> Column:
        return F.lit(origin) + (h * factor % span) / 1000.0

    lost = h % 89 == 0
    return numbered.select(
        (F.col("l_linenumber") % 2 + 1).alias("VendorID"),
        "tpep_pickup_datetime",
        F.expr("tpep_pickup_datetime + (h * 13 % 7200) * INTERVAL '1' SECOND").alias("tpep_dropoff_datetime"),
        (h % 11).cast("int").alias("passenger_count"),
        F.when(h % 50 == 0, 0.0).otherwise(F.col("l_quantity") / 4.0).alias("trip_distance"),
        F.when(lost, 0.0).otherwise(place(5, 230, -74.05)).alias("pickup_longitude"),
        F.when(lost, 0.0).otherwise(place(3, 350, 40.56)).alias("pickup_latitude"),
        (h % 6 + 1).cast("int").alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("store_and_fwd_flag"),
        place(19, 230, -74.05).alias("dropoff_longitude"),
        place(11, 350, 40.56).alias("dropoff_latitude"),
        (h % 4 + 1).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.round(fare * F.col("l_discount"), 2).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.round(fare * 1.2, 2).alias("total_amount"),
        "h",
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lines(read_table(spark, sf_dir, "lineitem"))


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips with features, ``h`` kept."""
    return cleaning.with_features(cleaning.keep_valid(raw_trips(spark, sf_dir)))


def census_text(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """Census rows as text: some incomes are "-", some codes have lost their leading zero.

    ``sparse`` gives every seventh zone a code that no zone has, so that the default income is used.
    """
    codes = F.expr("array(" + ", ".join(f"'{row[5]}'" for row in zone_rows()[:70]) + ")")
    i = F.col("i")
    income = F.expr("cast(25000 + (i * 1237) % 80000 + floor(c_acctbal / 10) as string)")
    rows = read_table(spark, sf_dir, "customer").withColumn("i", F.col("c_custkey") % 80)
    code = F.when(i < 70, F.get(codes, i.cast("int"))).otherwise((i + 1000).cast("string"))
    return rows.select(
        (F.when(i % 7 == 0, (i + 20_000).cast("string")).otherwise(code) if sparse else code).alias("ZIP"),
        F.when(F.col("c_custkey") % 37 == 0, "-").otherwise(income).alias("income_text"),
    )


def enriched_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_trips(
        valid_trips(spark, sf_dir), lookup.zone_table(spark), census_text(spark, sf_dir)
    )


def metered(trips: DataFrame) -> DataFrame:
    """Trips with a fare that follows distance and duration, and the area's income where it is known.

    Prices of order lines depend on nothing that a trip has, so a model could learn nothing from them.
    """
    extra = F.lit(0.0)
    if "income_category" in trips.columns:
        extra = F.when(F.col("income_category") == "low", 9.0).when(F.col("income_category") == "medium", 4.0).otherwise(0.0)
    noise = (F.col("h") % 41 - 20) / 20.0
    fare = 4.0 + F.col("trip_distance") * 2.5 + F.col("trip_duration_minutes") * 0.05 + extra + noise
    return trips.withColumn("fare_amount", F.round(fare, 2))


def predicted_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched trips with two predictions by formula: one that overcharges by income band, one that does not."""
    h, fare, band = F.col("h"), F.col("fare_amount"), F.col("income_category")
    factor = F.when(band == "low", 1.23).when(band == "medium", 1.09).otherwise(1.02)
    predicted = enriched_trips(spark, sf_dir).withColumns(
        {
            "predicted_fare_baseline": fare * factor + (h % 101 - 50) / 100.0,
            "predicted_fare_fair": fare * 1.02 + (h * 7 % 101 - 50) / 100.0,
        }
    )
    return with_errors(predicted, "fare_amount", MODELS)
