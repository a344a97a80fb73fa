"""Samples and splits. Those by hash depend on row content only and repeat on any cluster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.functions import columns as C

RESOLUTION = 10_000


def bernoulli(df: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified(df: DataFrame, column: str, fractions: Mapping[str, float], seed: int = 42) -> DataFrame:
    return df.sampleBy(column, fractions=dict(fractions), seed=seed)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> list[DataFrame]:
    return df.randomSplit([train, 1.0 - train], seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    return df.filter(C.hash_bucket(*keys, buckets=RESOLUTION) < int(round(fraction * RESOLUTION)))


def hash_split(df: DataFrame, keys: Sequence[str], train: float = 0.8) -> list[DataFrame]:
    """Two parts by content; equal rows stay together."""
    in_train = C.hash_bucket(*keys, buckets=RESOLUTION) < int(round(train * RESOLUTION))
    return [df.filter(in_train), df.filter(~in_train)]


def fixed_size(df: DataFrame, keys: Sequence[str], size: int = 5000) -> DataFrame:
    """The ``size`` rows whose keys hash lowest: a uniform draw that repeats everywhere.

    A plain top-n would send up to ``size`` rows of every partition to one task. Lower hashes have more leading
    zeros, so a count by the number of zeros tells how many are needed for ``size`` rows; all others are filtered
    before the sort.
    """
    digest = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256)
    digits = F.length(F.ltrim(digest, F.lit("0")))
    seen, bound = 0, None
    for row in df.groupBy(digits.alias("digits")).count().orderBy("digits").collect():  # at most 65 rows
        seen, bound = seen + row["count"], row["digits"]
        if seen >= size:
            break
    kept = df if bound is None else df.filter(digits <= bound)
    return kept.orderBy(digest, *df.columns).limit(size)
