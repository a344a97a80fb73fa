"""Joins of a large fact table to a keyed dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 16
HOT_SHARE = 0.01
TRACKED = 4096  # keys that a sketch keeps
SKETCHES = 64  # sketches of this many groups of tasks before the last one


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of a table and about how many bytes their values take, from one pass."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return row["n"], row["bytes"]


def fits(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to copy to every executor, by its measured rows and bytes."""
    if max_rows <= 0:
        return False
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables with different columns put side by side, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])


def hot_keys(fact: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least a share of the rows, null keys among them.

    One pass counts the rows and sketches their keys. A sketch of TRACKED keys misstates a count by at most
    3.5 / TRACKED of the rows, so a key that reaches the share is always found, and no key is named that holds less
    than the share by twice that error. At most 1 / (share - error) keys are named, however many rows there are.
    """
    error = 3.5 / TRACKED
    if share <= 2 * error:
        raise ValueError(f"a share of {share} is within the error of the sketch, {error:.4f}")
    most = min(TRACKED, int(1 / (share - 2 * error)) + 2)
    key = fact.select(F.xxhash64(*keys).alias("key"))
    sketches = key.groupBy((F.spark_partition_id() % SKETCHES).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(key, {TRACKED})").alias("sketch")
    )
    whole = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch")
    )
    row = whole.select("n", F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    if row is None:
        return []
    least = max((share - error) * row["n"], 2)
    return sorted(item["item"] for item in row["top"] if item["count"] >= least)


def is_hot(keys: Sequence[Column], hot: Sequence[int]) -> Column:
    return F.xxhash64(*keys).isin(list(hot)) if hot else F.lit(False)


def spread(dim: DataFrame, hot: Column, salts: int) -> DataFrame:
    """The dimension with a salt: hot rows once per salt, all others with salt 0."""
    first = F.lit(0).cast("bigint")
    numbers = F.when(hot, F.sequence(first, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(first))
    return dim.withColumn("_salt", F.explode(numbers))


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    salts: int = SALTS,
    share: float = HOT_SHARE,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Shuffle join that cuts the hot keys of ``fact``, and no others, into ``salts`` parts.

    A key that holds a third of the rows is then spread over ``salts`` tasks, and only its rows of ``dim`` are
    repeated. Null keys are spread as well, though they join with nothing. The salt comes from the row and its input
    partition, so a recomputed task repeats it and equal rows of different partitions part. ``how`` is "left" or
    "inner". ``hot`` saves the pass over ``fact`` where its hot keys are known from a table with the same keys.
    """
    hot = hot_keys(fact, keys, share) if hot is None else hot
    if not hot:
        return fact.join(dim, keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns], F.spark_partition_id()), F.lit(salts))
    salted = fact.withColumn("_salt", F.when(is_hot([F.col(k) for k in keys], hot), salt).otherwise(F.lit(0).cast("bigint")))
    # Hashes go by type: the dimension's keys are tested as what the fact would hold.
    as_fact = [F.col(k).try_cast(fact.schema[k].dataType) for k in keys]
    return salted.join(spread(dim, is_hot(as_fact, hot), salts), [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a dimension that is unique by ``keys``: by broadcast when its measured size allows, else salted."""
    if fits(dim, max_rows):
        return fact.join(F.broadcast(dim), keys, how)
    return salted_join(fact, dim, keys, how, salts)
