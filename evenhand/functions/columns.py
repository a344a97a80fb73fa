"""Column expressions: time, speed, keys, bands, labels and rounding. All of them run in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenhand.fixed_values import HIGH_INCOME, MEDIUM_INCOME


def steady_round(value: Column, digits: int) -> Column:
    """Half-up rounding for reported means.

    Sums of doubles differ in the last bits with the order of rows, so a mean that lies on a tie could be
    rounded either way. Rounding to nine digits first gives the same report for every partitioning.
    """
    return F.round(F.round(value, 9), digits)


def steady_bround(value: Column, digits: int) -> Column:
    """As ``steady_round`` with ties to the even digit, which data-frame libraries use."""
    return F.bround(F.round(value, 9), digits)


def minutes_between(start: str, end: str) -> Column:
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return F.round(seconds / F.lit(60.0), 2)


def miles_per_hour(distance: Column, minutes: Column) -> Column:
    """Zero where no time passed."""
    return F.when(minutes > 0, F.round(F.try_divide(distance, minutes / 60.0), 2)).otherwise(F.lit(0.0))


def per_mile(amount: Column, distance: Column) -> Column:
    """Null instead of an error where the distance is zero."""
    return F.round(F.try_divide(amount, distance), 2)


def rush_hour(hour: Column, day: Column) -> Column:
    """Both rush spans include their last full hour; days count from Sunday = 1."""
    return (hour.between(7, 9) | hour.between(17, 19)) & day.between(2, 6)


def grid_key(lat: str, lon: str, digits: int = 2) -> Column:
    """Text key of the grid square around a point, ties to even."""
    return F.concat(
        F.bround(F.col(lat), digits).cast("string"), F.lit("_"), F.bround(F.col(lon), digits).cast("string")
    )


def content_id(*names: str, length: int = 16) -> Column:
    """Leading hex digits of SHA-256 over the joined text of columns. Equal rows share it: it is no unique key."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.col(n).cast("string") for n in names]), 256), 1, length)


def hash_bucket(*names: str, buckets: int = 100) -> Column:
    """Bucket of a row that depends on its content only, never on partitioning."""
    digest = F.sha2(F.concat_ws("|", *[F.col(n).cast("string") for n in names]), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def income_band(income: Column, medium: float = MEDIUM_INCOME, high: float = HIGH_INCOME) -> Column:
    """Bands closed on the left: an income equal to a bound belongs to the upper band."""
    return F.when(income >= high, "high").when(income >= medium, "medium").otherwise("low")


def income_bin(income: Column, medium: float = MEDIUM_INCOME, high: float = HIGH_INCOME) -> Column:
    """Bins closed on the right; nothing at or below zero falls in a bin."""
    return F.when(income <= 0, None).when(income <= medium, "low").when(income <= high, "medium").when(
        income.isNotNull(), "high"
    )


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def grade(score: Column, cuts: Sequence[float]) -> Column:
    """GOOD, MODERATE or POOR by two rising cuts."""
    return F.when(score < cuts[0], "GOOD").when(score < cuts[1], "MODERATE").otherwise("POOR")


def effect_label(d: Column, cuts: Sequence[float]) -> Column:
    return F.when(F.abs(d) > cuts[1], "large").when(F.abs(d) > cuts[0], "medium").otherwise("small")


def overcharge_pct(predicted: Column, actual: Column) -> Column:
    """By how many percent one mean exceeds another."""
    return F.try_divide(predicted - actual, actual) * 100.0


def relative_gain(before: Column, after: Column) -> Column:
    """Improvement in percent of a lower-is-better score; zero where there was nothing to improve."""
    return F.when(before > 0, F.try_divide(before - after, before) * 100.0).otherwise(F.lit(0.0))


#: All white space that text tools strip, beyond the blank that SQL trims.
BLANKS = r"[\s\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def text_value(raw: Column) -> Column:
    """Text without white space around it, null when blank."""
    return F.nullif(F.regexp_replace(raw, rf"^{BLANKS}|{BLANKS}$", ""), F.lit(""))


def _number(raw: Column) -> Column:
    """A decimal number; type suffixes, which a cast would read, make it no number."""
    text = text_value(raw)
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def text_to_int(raw: Column) -> Column:
    """Whole number read through a double, so "3.0" gives 3; null when it is none."""
    return _number(raw).try_cast("int")


def text_to_double(raw: Column, digits: int = 6) -> Column:
    return F.round(_number(raw), digits)
