"""One write that keeps the rows which pass every stage and tells how many each stage dropped.

Stages are conditions in order, as filters one after the other would be: a row is dropped
by the first whose condition is not true. All rows are read once. Those that pass are
written whole; of a dropped row its keys alone are written, under the stage that dropped it.
Counts come from the files' footers, and Spark commits a task's files once, so a task
that ran twice or a table that is read again counts the same. (Counters that tasks add to
on the way would count a lost shuffle's rows twice.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DROPPED = "dropped_by"
COLUMNS = "columns"
ROWS = "rows"


def write_stages(
    df: DataFrame, path: str, stages: Mapping[str, Column], keys: Sequence[str], mode: str = "error"
) -> None:
    """Write the rows by the stage that dropped them; survivors have no such stage.

    Stage names become folder names. A column named ``dropped_by`` cannot be kept.
    """
    if DROPPED in df.columns:
        raise ValueError(f"the table has a column {DROPPED}")
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"no column {', '.join(missing)}")
    if not stages or any(not name for name in stages):
        raise ValueError("stages need names")
    failed = [F.when(~F.coalesce(kept, F.lit(False)), F.lit(name)) for name, kept in stages.items()]
    marked = df.withColumn(DROPPED, F.coalesce(*failed))
    whole = [
        F.col(c) if c in keys else F.when(F.col(DROPPED).isNull(), F.col(c)).alias(c) for c in df.columns
    ]
    # The columns are written apart, so a table without rows has them too.
    df.limit(0).write.mode(mode).parquet(f"{path}/{COLUMNS}")
    marked.select(*whole, DROPPED).write.mode(mode).partitionBy(DROPPED).parquet(f"{path}/{ROWS}")


def _written(spark: SparkSession, path: str) -> DataFrame:
    # Given, not found: names of stages are text, whatever they look like.
    schema = spark.read.parquet(f"{path}/{COLUMNS}").schema.add(DROPPED, "string")
    return spark.read.schema(schema).parquet(f"{path}/{ROWS}")


def survivors(spark: SparkSession, path: str) -> DataFrame:
    """The rows that passed every stage; only their files are read."""
    return _written(spark, path).where(F.col(DROPPED).isNull()).drop(DROPPED)


def dropped(spark: SparkSession, path: str, keys: Sequence[str], stage: str | None = None) -> DataFrame:
    """Keys of the dropped rows with the stage that dropped each, or of one stage."""
    rows = _written(spark, path)
    wanted = F.col(DROPPED).isNotNull() if stage is None else F.col(DROPPED) == stage
    return rows.where(wanted).select(*keys, DROPPED)


def stage_ledger(spark: SparkSession, path: str, stages: Sequence[str]) -> DataFrame:
    """Rows ``stage, n_rows, n_dropped``: what was left after each stage and what it dropped.

    The stage ``read`` stands first, with all rows.
    """
    counted = _written(spark, path).groupBy(DROPPED).agg(F.count("*").alias("n"))
    by_stage = [F.sum(F.when(F.col(DROPPED) == s, F.col("n")).otherwise(0)) for s in stages]
    totals = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"),
        *[F.coalesce(n, F.lit(0)).alias(f"n_{i}") for i, n in enumerate(by_stage)],
    )
    left, lines = F.col("n_all"), [_line("read", F.col("n_all"), F.lit(0).cast("long"))]
    for i, stage in enumerate(stages):
        left = left - F.col(f"n_{i}")
        lines.append(_line(stage, left, F.col(f"n_{i}")))
    return totals.select(F.inline(F.array(*lines)))


def _line(stage: str, left: Column, gone: Column) -> Column:
    return F.struct(F.lit(stage).alias("stage"), left.alias("n_rows"), gone.alias("n_dropped"))
