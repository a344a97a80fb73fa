"""Area income and its join to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.fixed_values import DEFAULT_INCOME
from evenhand.functions import columns as C
from evenhand.operators.joins import MAX_BROADCAST_ROWS, fits, lookup_join
from evenhand.operators.lookup import first_match

ZONE_FIELDS = ["pickup_zip", "borough", "neighborhood", "median_income"]


def census_incomes(
    census: DataFrame, zip_col: str, income_col: str, prefixes=("10", "11"), pad_first: bool = False
) -> DataFrame:
    """Usable ``zip, income`` rows of a census table whose cells are text.

    A code that was read as a number has lost its leading zero. Its prefix is tested as it stands and it is
    padded after that, so "1001" passes as "10..." and ends as "01001"; ``pad_first`` pads before the test.
    """
    text = F.col(zip_col).cast("string")
    padded = F.lpad(text, 5, "0")
    tested = padded if pad_first else text
    wanted = tested.startswith(prefixes[0])
    for prefix in prefixes[1:]:
        wanted = wanted | tested.startswith(prefix)
    income = F.col(income_col).try_cast("double")
    return census.filter(wanted & (income > 0)).select(padded.alias("zip"), income.alias("income"))


def income_by_zip(
    census: DataFrame, zip_col: str = "ZIP", income_col: str = "income_text", pad_first: bool = False
) -> DataFrame:
    """One whole-dollar income per postal code: the mean of its usable entries."""
    rows = census_incomes(census, zip_col, income_col, pad_first=pad_first)
    return rows.groupBy("zip").agg(C.steady_round(F.avg("income"), 0).alias("median_income"))


def income_range(incomes: DataFrame) -> DataFrame:
    income = F.col("median_income")
    return incomes.agg(
        F.min(income).alias("min_income"),
        C.steady_round(F.avg(income), 0).alias("avg_income"),
        F.max(income).alias("max_income"),
    )


def attach_income(
    fact: DataFrame,
    incomes: DataFrame,
    zip_col: str = "pickup_zip",
    default: float = DEFAULT_INCOME,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left join of area income by postal code; codes without one get ``default``. Adds the income band."""
    joined = lookup_join(fact, incomes.withColumnRenamed("zip", zip_col), [zip_col], "left", max_rows)
    income = F.coalesce(F.col("median_income"), F.lit(default))
    return joined.select(
        *fact.columns, income.alias("median_income"), C.income_band(income).alias("income_category")
    )


def zones_with_income(zones: DataFrame, census: DataFrame, default: float = DEFAULT_INCOME, **census_columns) -> DataFrame:
    """Zone table with the income of each zone.

    Only codes of zones are kept before the census is aggregated, so the aggregate has at most as many rows as
    the zone table. Both are broadcast when the zone table is counted small enough.
    """
    hint = F.broadcast if fits(zones, MAX_BROADCAST_ROWS) else (lambda table: table)
    rows = census_incomes(census, **{"zip_col": "ZIP", "income_col": "income_text", **census_columns})
    of_zones = rows.join(hint(zones.select("zip").distinct()), "zip", "left_semi")
    incomes = of_zones.groupBy("zip").agg(C.steady_round(F.avg("income"), 0).alias("known_income"))
    joined = zones.join(hint(incomes), "zip", "left")
    return joined.withColumn("median_income", F.coalesce("known_income", F.lit(default))).drop("known_income")


def enrich_trips(trips: DataFrame, zones: DataFrame, census: DataFrame, **census_columns) -> DataFrame:
    """Trips inside a zone, with code, borough, neighbourhood, area income and income band.

    Income depends on the zone alone. It is joined to the small zone table first, so the trips take everything
    from one lookup and are neither joined twice nor shuffled.
    """
    areas = zones_with_income(zones, census, **census_columns).withColumnRenamed("zip", "pickup_zip")
    found = first_match(trips, areas, ZONE_FIELDS, keep_unmatched=False, sized_by=zones)
    return found.withColumn("income_category", C.income_band(F.col("median_income")))


def mapped_share(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """How many trips there are and how many fall in a zone."""
    found = first_match(trips, zones, ["zip"])
    return found.agg(F.count(F.lit(1)).alias("trips"), F.count("zip").alias("mapped")).withColumn(
        "mapped_pct", F.round(F.try_divide(F.col("mapped"), F.col("trips")) * 100.0, 1)
    )


def with_predictions(trips: DataFrame, predicted: DataFrame, predictions: list[str], key: str = "trip_id") -> DataFrame:
    """Trips with their predictions, by equal ids; trips without one keep nulls.

    Ids repeat where trips have the same content. Such trips have equal features, so their predictions are equal up
    to rounding: each id's mean stands for all of them, and no trip is doubled.
    """
    per_id = predicted.groupBy(key).agg(*[F.avg(p).alias(p) for p in predictions])
    return trips.join(per_id, key, "left")
