import pytest
from pyspark.sql import functions as F

from opinara.operators.ledger import dropped, stage_ledger, survivors, write_stages

ROWS = [("a", 1, "x"), ("b", None, "y"), ("c", 5, None), ("c", 5, "z"), (None, 9, "x")]
NAMES = ["2024", "small"]


def stages():
    return {"2024": F.col("n") < 9, "small": F.col("n") < 4}


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, "id string, n int, text string")


def test_stages_drop_as_filters_do(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_stages(table, path, stages(), ["id"])
    found = survivors(spark, path)
    assert found.schema == table.schema and found.collect() == [("a", 1, "x")]
    # A condition that is NULL drops the row, as a filter does.
    assert sorted(map(str, dropped(spark, path, ["id"]).collect())) == sorted(
        f"Row(id={i!r}, dropped_by={s!r})" for i, s in [("b", "2024"), (None, "2024"), ("c", "small"), ("c", "small")]
    )
    assert dropped(spark, path, ["id"], "small").count() == 2
    ledger = [tuple(r) for r in stage_ledger(spark, path, NAMES).collect()]
    assert ledger == [("read", 5, 0), ("2024", 3, 2), ("small", 1, 2)]
    kept, left = table, []
    for condition in stages().values():
        kept = kept.where(condition)
        left.append(kept.count())
    assert [n for _, n, _ in ledger[1:]] == left


def test_of_dropped_rows_only_keys_are_written(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_stages(table, path, stages(), ["id"])
    gone = spark.read.parquet(f"{path}/rows").where("dropped_by IS NOT NULL")
    assert {(r["n"], r["text"]) for r in gone.collect()} == {(None, None)}


def test_counting_reads_no_column(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_stages(table, path, stages(), ["id"])
    plan = stage_ledger(spark, path, NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


@pytest.mark.parametrize("condition", [True, False])
def test_all_or_none(spark, table, tmp_path, condition):
    path = str(tmp_path / "t")
    write_stages(table, path, {"only": F.lit(condition)}, ["id"])
    kept = survivors(spark, path).count()
    assert [tuple(r) for r in stage_ledger(spark, path, ["only"]).collect()] == [
        ("read", 5, 0), ("only", kept, 5 - kept),
    ]


def test_no_rows(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_stages(table.where("false"), path, stages(), ["id"])
    assert survivors(spark, path).columns == ["id", "n", "text"] and survivors(spark, path).count() == 0
    assert [tuple(r)[1:] for r in stage_ledger(spark, path, NAMES).collect()] == [(0, 0)] * 3


def test_what_cannot_be_written(spark, table, tmp_path):
    for df, given, keys in (
        (table.withColumn("dropped_by", F.lit(1)), stages(), ["id"]),
        (table, stages(), ["other"]),
        (table, {}, ["id"]),
        (table, {"": F.lit(True)}, ["id"]),
    ):
        with pytest.raises(ValueError):
            write_stages(df, str(tmp_path / "t"), given, keys)
