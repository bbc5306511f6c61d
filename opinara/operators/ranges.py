"""A table in order without a sort or window over all of it in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.session import materialise


def in_ranges(
    df: DataFrame, order: Sequence[Column], name: str, ranges: int | None = None
) -> DataFrame:
    """The rows cut into ranges of ``order``, numbered by ``_range`` in that order.

    As many ranges as the session has shuffle partitions, unless a number is
    given. Bounds come from a sample, so the numbers are written with the rows:
    a later job cannot see other bounds. Rows that are equal in ``order`` share a
    range. ``df`` is read twice and should be a written table.
    """
    number = [ranges] if ranges else []
    placed = df.repartitionByRange(*number, *order)
    return materialise(placed.withColumn("_range", F.spark_partition_id()), name)


def with_sums_before(placed: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Each row with the sums over all ranges before its own, and over all of them.

    The columns are ``{name}_before`` and ``{name}_total``. The sums are one row
    for each range, hence windows without partition and a broadcast.
    """
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    own = placed.groupBy("_range").agg(*[total.alias(name) for name, total in sums.items()])
    columns = []
    for name in sums:
        columns.append(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_before"))
        columns.append(F.sum(name).over(everything).alias(f"{name}_total"))
    return placed.join(F.broadcast(own.select("_range", *columns)), "_range")
