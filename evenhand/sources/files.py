"""File sources and sinks. Every path is any URI that Spark's file systems reach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from evenhand import schemas

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_trips_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType = schemas.RAW_TRIPS) -> DataFrame:
    """Delimited trips with a header, by a fixed schema; a glob or a list names several files.

    Columns bind by position, malformed cells become null, and so do empty ones.
    """
    reader = spark.read.schema(schema).option("header", True).option("timestampFormat", TIME_FORMAT)
    return reader.option("enforceSchema", True).option("nullValue", "").csv(path)


FAULTY_LINE = "faulty_line"


def read_trips_checked(
    spark: SparkSession, path: str | Sequence[str], schema: StructType = schemas.RAW_TRIPS, check_header: bool = True
) -> DataFrame:
    """Trips as ``read_trips_csv`` gives them and, from the same scan, ``faulty_line``.

    It holds the whole line where a cell does not fit its type or where cells are missing or left over, and null for
    all other rows. A header with other names, or in another order, raises an error that names the file; lines bind by
    position, so such a file would be read wrongly throughout. All cells are parsed, whichever are asked for later.
    """
    checked = StructType([*schema.fields, StructField(FAULTY_LINE, StringType())])
    reader = spark.read.schema(checked).option("header", True).option("timestampFormat", TIME_FORMAT).option("nullValue", "")
    table = reader.option("columnNameOfCorruptRecord", FAULTY_LINE).option("enforceSchema", not check_header).csv(path)
    # the reader converts, and so finds faults in, only cells that somebody asks for: the lost fields ask for all
    return table.withColumn(FAULTY_LINE, F.when(F.size(fault_fields(schema)) >= 0, F.col(FAULTY_LINE)))


def fault_fields(schema: StructType = schemas.RAW_TRIPS, line: str = FAULTY_LINE) -> Column:
    """Names of the fields whose text was lost, null without a fault; empty where the number of cells is the fault."""
    texts = ", ".join(f"`{name}` string" for name in schema.fieldNames())
    cells = F.from_csv(F.col(line), F.lit(texts), {"nullValue": ""})
    lost = [F.when(cells[name].isNotNull() & F.col(name).isNull(), name) for name in schema.fieldNames()]
    return F.when(F.col(line).isNotNull(), F.array_compact(F.array(*lost)))


def write_kinds(rows: DataFrame, path: str, kind: str = "kind") -> None:
    """Rows of several kinds from one pass, a folder for each kind."""
    rows.write.mode("overwrite").option("compression", "snappy").partitionBy(kind).parquet(path)


def read_kind(spark: SparkSession, path: str, schema: StructType, value: str, kind: str = "kind") -> DataFrame:
    """Rows of one kind; none where nothing of that kind was written."""
    whole = StructType([*schema.fields, StructField(kind, StringType())])
    return spark.read.schema(whole).parquet(path).filter(F.col(kind) == value).drop(kind)


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Delimited file with a header and every cell as text, to be typed by the reader's own rules.

    Inference would read the file twice and could turn a code such as 01001 into a number.
    """
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delimited file whose types are guessed from its cells."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_census_csv(
    spark: SparkSession, path: str, zip_header: str = "ZIP", income_header: str = "Households Median Income (Dollars)"
) -> DataFrame:
    """Census file as ``ZIP, income_text``; a numeric code comes out without leading zeros."""
    table = read_text_table(spark, path)
    code = F.col(f"`{zip_header}`")
    return table.select(
        F.coalesce(code.try_cast("bigint").cast("string"), code).alias("ZIP"),
        F.col(f"`{income_header}`").alias("income_text"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder, whatever its part files."""
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A delimited result folder written by ``write_small_csv`` or ``write_rows_csv``."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


def read_heads(spark: SparkSession, paths: Sequence[str], rows: int, schema: StructType = schemas.RAW_TRIPS) -> DataFrame:
    """The first rows of each of several files as one table."""
    heads = [read_trips_csv(spark, p, schema).limit(rows) for p in paths]
    table = heads[0]
    for more in heads[1:]:
        table = table.unionByName(more)
    return table


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Snappy Parquet, replacing what is there. ``files`` merges parts without a shuffle."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One delimited file with a header, for tables of group rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_rows_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Row-level delimited output. ``files`` merges parts; that many tasks then do all the writing."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_trips_csv(df: DataFrame, path: str) -> None:
    """Delimited trips as ``read_trips_csv`` takes them."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", TIME_FORMAT).option(
        "timestampNTZFormat", TIME_FORMAT
    ).csv(path)


def write_report_json(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON document."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
