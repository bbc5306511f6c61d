"""Few labels against many bodies: find the ids first, then read bodies only where they are.

Bodies are most of a comment table, and a label set names few of its rows. The ids are
joined first, from the id column alone. The ids found are cut into ranges, and a scan of
the bodies takes the ranges as a filter that Parquet compares with each row group's and
page's least and greatest id, so a row group none of whose ids can match is not read.

The ranges are ``RANGES`` at most, whatever the number of labels, and they are the only
thing that reaches the driver. They only leave rows out that the join would leave out:
the join on the id follows in any case. On a table sorted by id the filter skips whole row
groups; on one that is not, it skips little and the id column has been read once in vain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators.joins import attach_labels
from opinara.session import materialise

RANGES = 256


def id_ranges(ids: DataFrame, id: str, ranges: int = RANGES) -> list[tuple]:
    """Least and greatest id of each of at most ``ranges`` parts of the ids in order."""
    parted = ids.where(F.col(id).isNotNull()).select(id).repartitionByRange(ranges, id)
    bounds = parted.groupBy(F.spark_partition_id().alias("_range")).agg(
        F.min(id).alias("least"), F.max(id).alias("most")
    )
    return sorted((row["least"], row["most"]) for row in bounds.collect())


def within(id: Column, ranges: list[tuple]) -> Column:
    """True where the id lies in one of the ranges; in a form that scans can use."""
    if not ranges:
        return F.lit(False)
    return _any([(id >= F.lit(low)) & (id <= F.lit(high)) for low, high in ranges])


def _any(conditions: list[Column]) -> Column:
    """One condition of many, as a balanced tree: a chain would be as deep as it is long."""
    if len(conditions) > 2:
        half = len(conditions) // 2
        return _any(conditions[:half]) | _any(conditions[half:])
    return reduce(lambda a, b: a | b, conditions)


def matched_ids(comments: DataFrame, labels: DataFrame, on: tuple[str, str]) -> DataFrame:
    """The ids that are in both tables, each once, written; reads no other column."""
    left, right = on
    wanted = labels.select(F.col(right).alias("_wanted")).where(F.col(right).isNotNull()).distinct()
    found = comments.select(left).join(wanted, F.col(left) == F.col("_wanted"), "left_semi")
    return materialise(found.distinct(), "matched_ids")


def attach_labels_late(
    comments: DataFrame, labels: DataFrame, on: tuple[str, str] = ("id", "iid"), ranges: int = RANGES
) -> DataFrame:
    """``attach_labels``'s rows, from the row groups of ``comments`` that hold labelled ids.

    ``comments`` should be a Parquet scan whose id column is one of the file's own: a
    computed id cannot be compared with what the files state.
    """
    left, _ = on
    bounds = id_ranges(matched_ids(comments, labels, on), left, ranges)
    return attach_labels(comments.where(within(F.col(left), bounds)), labels, on)
