"""Writers for tables, reports and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_table(
    df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()
) -> None:
    """Write parquet, by default failing if the path exists.

    A partitioned write gathers each key's rows first, so that a key gets few
    files; the rebalance splits a key that holds much of the table.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_report_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "error"
) -> None:
    """Write a report as CSV, one file for each partition the report has."""
    df.write.mode(mode).option("header", header).csv(path)


def write_json_lines(
    df: DataFrame, path: str, compression: str = "bzip2", mode: str = "error"
) -> None:
    df.write.mode(mode).option("compression", compression).json(path)


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
