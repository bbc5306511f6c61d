"""Readers for the input tables and for saved models.

JSON and CSV come as lines, so plain and bzip2 files split across tasks; the
codec follows from the file's extension.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from opinara.sources import schemas


def _read(
    spark: SparkSession, path: str, fmt: str, schema: StructType, mode: str, corrupt: str | None
) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt != "json":
        raise ValueError(f"unknown format {fmt!r}")
    # Numbers come bare or in quotes, so they are read as text and cast.
    as_text = StructType([StructField(f.name, StringType(), True) for f in schema])
    reader = spark.read.option("mode", mode)
    if corrupt:
        as_text = as_text.add(corrupt, StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    raw = reader.schema(as_text).json(path)
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return raw.select(*cast, *([corrupt] if corrupt else []))


def read_comments(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    mode: str = "FAILFAST",
    corrupt: str | None = None,
) -> DataFrame:
    """Comments by the declared schema; a line that is no JSON fails the read.

    With ``mode="PERMISSIVE"`` and a name in ``corrupt`` such lines come as rows that
    hold their text in that column, to be counted and set aside; with
    ``"DROPMALFORMED"`` they are left out.
    """
    return _read(spark, path, fmt, schemas.COMMENTS, mode, corrupt)


def read_submissions(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    mode: str = "FAILFAST",
    corrupt: str | None = None,
) -> DataFrame:
    """Submissions, read as ``read_comments`` reads comments."""
    return _read(spark, path, fmt, schemas.SUBMISSIONS, mode, corrupt)


def read_labels(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Label text as it stands in the file; ``label_value`` makes integers of it.

    Columns are found by the header's names, in any order and among others.
    """
    found = spark.read.option("header", True).option("sep", delimiter).csv(path)
    missing = [f.name for f in schemas.LABELS if f.name not in found.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    return found.select(*[f.name for f in schemas.LABELS])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_model(path: str) -> Model:
    """A saved model of whatever kind: a pipeline, a classifier, or a cross-validation with its metrics."""
    return DefaultParamsReader.loadParamsInstance(path, SparkContext.getOrCreate())
