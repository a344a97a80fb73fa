"""What the operators share: code on the executors, written tables, safe column names."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.session import passing_shuffles, written

#: Words of the corpus contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "discard", "documents", "only", "passing_shuffles", "ship", "word_count", "written"]


#: Rows per batch, with Spark's defaults and what suits texts better.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers can import it anywhere.

    Batches of Spark's default number of rows would be large with long texts; where nobody chose a number it is lowered.
    """
    for name, (default, rows) in BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, rows)
    package = Path(__file__).resolve().parent.parent
    if any(path.endswith("evenhand-code.zip") for path in spark.sparkContext.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="evenhand-code-")) / "evenhand-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))


def discard(table: DataFrame) -> None:
    """Remove a table that ``written`` made and that nothing will read again."""
    spark = table.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    for folder in folders:
        if folder.rsplit("/", 1)[1].startswith("evenhand-"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names; all others, whatever they are called, are left behind."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
