"""Counts and rates over 0/1 flags.

A rate is the mean of a flag over the rows where it is not NULL. All are plain
grouped means, which Spark aggregates before the shuffle, so a key that holds
much of the table costs one row for each task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Keys = Sequence[str | Column]


def rates(
    df: DataFrame,
    keys: Keys,
    measures: Mapping[str, str],
    order: Sequence[Column] | None = None,
    support: str | None = None,
) -> DataFrame:
    """The rate of each measure by key: ``measures`` maps output name to flag.

    ``support`` names an extra column with the number of rows.
    """
    columns = [F.avg(flag).alias(name) for name, flag in measures.items()]
    if support:
        columns.append(F.count("*").alias(support))
    grouped = df.groupBy(*keys).agg(*columns)
    return grouped.orderBy(*order) if order else grouped


def compare_subset(df: DataFrame, predicate: Column, measures: Mapping[str, str]) -> DataFrame:
    """One row with each rate over the rows that match and over all rows."""
    columns = []
    for name, flag in measures.items():
        columns.append(F.avg(F.when(predicate, F.col(flag))).alias(f"{name}_subset"))
        columns.append(F.avg(flag).alias(f"{name}_all"))
    return df.agg(*columns)


def top_rates(
    grouped: DataFrame, keys: Sequence[str], rate: str = "rate", k: int = 10, min_support: int = 1
) -> DataFrame:
    """The k rows with the highest rate among grouped rates; equal rates go by key."""
    supported = grouped.where(F.col("support") >= F.lit(min_support))
    ranked = [F.desc_nulls_last(rate), *[F.asc(key) for key in keys]]
    return supported.orderBy(*ranked).limit(k)


def top_groups(
    df: DataFrame, keys: Sequence[str], measure: str, k: int = 10, min_support: int = 1
) -> DataFrame:
    """The k groups with the highest rate of the flag."""
    grouped = rates(df, keys, {"rate": measure}, support="support")
    return top_rates(grouped, keys, "rate", k, min_support)


def tally(df: DataFrame, keys: Keys, measures: Mapping[str, str]) -> DataFrame:
    """Sums and counts of the flags by key, from which coarser rates follow.

    Comments tallied by submission join as one row each instead of one for each
    comment, so neither many comments nor a submission that holds a third of
    them reach the join.
    """
    columns = [F.count("*").alias("n_rows")]
    for name, flag in measures.items():
        columns.append(F.sum(flag).alias(f"{name}_sum"))
        columns.append(F.count(flag).alias(f"{name}_count"))
    return df.groupBy(*keys).agg(*columns)


def _tallied_rate(name: str, predicate: Column | None = None) -> Column:
    def total(part: str) -> Column:
        column = F.col(f"{name}_{part}")
        return F.sum(column if predicate is None else F.when(predicate, column))

    return F.try_divide(total("sum"), total("count"))


def rates_of_tally(
    tallied: DataFrame,
    keys: Keys,
    names: Iterable[str],
    order: Sequence[Column] | None = None,
    support: str | None = None,
) -> DataFrame:
    """``rates`` from tallied rows."""
    columns = [_tallied_rate(name).alias(name) for name in names]
    if support:
        columns.append(F.sum("n_rows").alias(support))
    grouped = tallied.groupBy(*keys).agg(*columns)
    return grouped.orderBy(*order) if order else grouped


def compare_subset_of_tally(
    tallied: DataFrame, predicate: Column, names: Iterable[str]
) -> DataFrame:
    """``compare_subset`` from tallied rows, by a predicate on their keys."""
    columns = []
    for name in names:
        columns.append(_tallied_rate(name, predicate).alias(f"{name}_subset"))
        columns.append(_tallied_rate(name).alias(f"{name}_all"))
    return tallied.agg(*columns)


def stage_counts(df: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """One row: the rows of the table and, for each flag, the rows where it is 1."""
    counted = [F.count_if(F.col(flag) == 1).alias(flag) for flag in flags]
    return df.agg(F.count("*").alias("n_rows"), *counted)


def observe_counts(df: DataFrame, flags: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The table, and its row and flag counts once a job over it has run.

    Counting on the way through a write saves the scan that a count would take.
    """
    observation = Observation()
    counted = [F.count_if(F.col(flag) == 1).alias(flag) for flag in flags]
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *counted), observation


def count_stages(stages: Mapping[str, DataFrame]) -> DataFrame:
    """The row count of each named table, as rows ``stage, n_rows``."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def store_tally(
    df: DataFrame, path: str, day: str, keys: Sequence[str], measures: Mapping[str, str], days: Sequence | None = None
) -> None:
    """Write the tallies of ``df`` by day and keys; with ``days``, those days anew and no others.

    Each day is a partition of its own, and only the days written are replaced, so
    appended or corrected days cost one reading of them. A day named in ``days`` that has no
    rows any more keeps nothing. The rows of the given days must all be in ``df``.
    """
    chosen = df if days is None else df.where(F.col(day).isin(list(days)))
    tallied = tally(chosen, [day, *keys], measures)
    if days is not None:
        # A row of zeros for each day replaces what was there, should no other row come.
        listed = df.sparkSession.createDataFrame([(d,) for d in days], df.select(day).schema)
        blank = [F.lit(None).cast(t).alias(c) for c, t in tallied.dtypes if c in keys]
        zeros = [F.lit(0).cast(t).alias(c) for c, t in tallied.dtypes if c not in keys and c != day]
        tallied = tallied.unionByName(listed.select(day, *blank, *zeros))
    write = tallied.write.mode("overwrite").partitionBy(day)
    write.option("partitionOverwriteMode", "static" if days is None else "dynamic").parquet(path)


def stored_rates(
    stored: DataFrame, keys: Keys, names: Iterable[str], order: Sequence[Column] | None = None, support: str | None = None
) -> DataFrame:
    """``rates`` from stored tallies of any days, by any of the day and the keys."""
    return rates_of_tally(stored.where("n_rows > 0"), keys, names, order, support)
