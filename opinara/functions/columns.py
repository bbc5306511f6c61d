"""Small column expressions: keys, dates, targets, rates and shading."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def link_key(col: Column, prefix: str = "t3_") -> Column:
    """The prefixed foreign key under which comments name their submission."""
    return F.concat(F.lit(prefix), col.cast("string"))


def epoch_date(col: Column) -> Column:
    """UTC calendar day of epoch seconds, whatever the session's time zone."""
    days = F.floor(col.cast("long") / F.lit(SECONDS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def parse_date(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date from text; text that does not parse gives NULL."""
    return F.try_to_date(col, fmt)


def label_value(col: Column) -> Column:
    """Label text as an integer; text that is not a number gives NULL."""
    return col.try_cast("int")


def is_target(label: Column, value: int) -> Column:
    """1 where the label has the value, else 0, also for NULL labels."""
    return F.when(label == F.lit(value), 1).otherwise(0)


def title_matches(col: Column, term: str, ignore_case: bool = False) -> Column:
    """True where the title holds the term; case counts unless told otherwise."""
    if ignore_case:
        return F.contains(F.lower(col), F.lit(term.lower()))
    return F.contains(col, F.lit(term))


def rate_diff(positive: Column, negative: Column) -> Column:
    return negative - positive


def intensity(col: Column, lo: float, hi: float, clamp: bool = True) -> Column:
    """Shade between 0 and 1, darkest at ``lo``.

    Without ``clamp`` values below ``lo`` give NaN and those above ``hi`` go
    below zero.
    """
    share = (col - F.lit(lo)) / F.lit(hi - lo)
    if clamp:
        inside = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
        share = F.when(col.isNotNull(), inside)
    return F.lit(1.0) - F.sqrt(share)


def positive_probability(col: Column) -> Column:
    """Probability of class 1 out of a classifier's probability vector."""
    return F.when(col.isNotNull(), F.get(vector_to_array(col), F.lit(1)))


def hash_bucket(col: Column, buckets: int, seed: int = 0) -> Column:
    """Bucket number from the value alone.

    Unlike ``rand`` it gives the same bucket when a lost partition is computed
    again, after a repartition, and in any other engine that has MD5. NULL has a
    bucket too.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), col.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(buckets)).cast("int")
