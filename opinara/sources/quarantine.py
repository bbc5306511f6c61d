"""Reading lines of doubtful quality: good rows go on, bad lines are set aside with a reason.

``ingest_json`` and ``ingest_csv`` read every line once and write one table, parted into
good rows and bad lines. A bad line keeps its text, its file, the block of the file it
was read in, and the reason:

* ``malformed``: no JSON object, or a CSV line with more or fewer fields than the header;
* ``field <name>``: a value that is there but cannot be of the column's type. The first
  such column in the schema's order is named.

Empty lines are no lines. A CSV field that is empty is NULL. Counts come from what was
written, so tasks that ran twice count once. If the share of bad lines is above ``most_bad``
the read fails, and the table stays, so the lines can be looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

MALFORMED = "malformed"
_BAD = "_bad"
_LINE = StructType(
    [
        StructField("_reason", StringType()),
        StructField("_line", StringType()),
        StructField("_file", StringType()),
        StructField("_block", LongType()),
    ]
)


class TooManyBadLines(ValueError):
    """The share of bad lines is above the limit; ``path`` holds the table with them."""

    def __init__(self, path: str, bad: int, lines: int, most_bad: float):
        super().__init__(f"{bad} of {lines} lines are bad, more than {most_bad:.4%}; see {path}")
        self.path, self.bad, self.lines = path, bad, lines


@dataclass
class Ingested:
    """What an ingest has written; ``good`` and ``bad`` read their part of it alone."""

    spark: SparkSession
    path: str
    schema: StructType

    def _part(self, bad: bool) -> DataFrame:
        whole = StructType([*self.schema, *_LINE, StructField(_BAD, StringType())])
        return self.spark.read.schema(whole).parquet(self.path).where(F.col(_BAD) == str(bad).lower())

    @property
    def good(self) -> DataFrame:
        return self._part(False).select(*self.schema.names)

    @property
    def bad(self) -> DataFrame:
        """The bad lines: reason, line, file, and the block's first byte in the file."""
        return self._part(True).select(*[F.col(f.name).alias(f.name[1:]) for f in _LINE])

    def by_reason(self) -> DataFrame:
        return self.bad.groupBy("reason").agg(F.count("*").alias("n_lines"))


def _named(schema: StructType) -> None:
    if taken := {_BAD, *_LINE.names} & set(schema.names):
        raise ValueError(f"the schema uses the names {sorted(taken)}")


def _unfit(schema: StructType) -> list[Column]:
    """For each column of another type than text, the reason if its text does not fit."""
    return [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f"field {f.name}")
        for f in schema
        if f.dataType != StringType()
    ]


def _write(raw: DataFrame, schema: StructType, path: str, most_bad: float) -> Ingested:
    """Write rows of texts with a ``_line`` where they could not be parsed."""
    spark, reason = raw.sparkSession, F.when(F.col("_line").isNotNull(), MALFORMED)
    told = raw.withColumn("_reason", F.coalesce(reason, *_unfit(schema)))
    good = F.col("_reason").isNull()
    as_read = F.to_json(F.struct(*schema.names))
    rows = told.select(
        *[F.when(good, F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema],
        "_reason",
        F.when(~good, F.coalesce("_line", as_read)).alias("_line"),
        F.when(~good, F.col("_file")).alias("_file"),
        F.when(~good, F.col("_block")).alias("_block"),
        F.when(good, "false").otherwise("true").alias(_BAD),
    )
    rows.write.partitionBy(_BAD).parquet(path)
    held = Ingested(spark, path, schema)
    bad, kept = held._part(True).count(), held._part(False).count()  # from the files' footers
    if bad > most_bad * (bad + kept):
        raise TooManyBadLines(path, bad, bad + kept, most_bad)
    return held


def _placed() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]


def _as_text(names: list[str]) -> StructType:
    return StructType([*[StructField(n, StringType()) for n in names], StructField("_line", StringType())])


def ingest_json(
    spark: SparkSession, source: str, schema: StructType, path: str, most_bad: float = 0.01
) -> Ingested:
    """JSON lines in ``source`` by ``schema`` into a table at ``path``.

    Numbers may come bare or in quotes. A field that is missing is NULL; fields the schema
    does not name are left out. The line of an unfit value is kept as its read fields.
    """
    _named(schema)
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    raw = reader.schema(_as_text(schema.names)).json(source)
    return _write(raw.select(*schema.names, "_line", *_placed()), schema, path, most_bad)


def ingest_csv(
    spark: SparkSession,
    source: str,
    schema: StructType,
    path: str,
    delimiter: str = ",",
    most_bad: float = 0.01,
) -> Ingested:
    """CSV with a header in ``source``, columns by name, into a table at ``path``.

    All files have the header of the first; another header fails the read.
    """
    _named(schema)
    reader = spark.read.option("header", True).option("sep", delimiter)
    found = reader.csv(source).columns
    if missing := [n for n in schema.names if n not in found]:
        raise ValueError(f"no column {', '.join(missing)} in {source}")
    # The parser must read all fields, or it cannot tell that a line has too few.
    strict = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    strict = strict.option("columnPruning", False).option("enforceSchema", False)
    raw = strict.schema(_as_text(found)).csv(source)
    return _write(raw.select(*schema.names, "_line", *_placed()), schema, path, most_bad)
