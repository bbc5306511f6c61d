import os

import pytest
from pyspark.sql import functions as F

from opinara.operators.stages import ATTEMPT, Flow


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(100).withColumn("k", F.col("id") % 7).write.parquet(path)
    return path


def declared(spark, folder, source, least=3, fail=False):
    flow = Flow(spark, folder)

    def tally(kept):
        if fail:
            raise RuntimeError("stopped")
        return kept.groupBy("k").agg(F.count("*").alias("n"))

    flow.add("kept", lambda t, least: t.where(F.col("k") >= least), spark.read.parquet(source), parameters={"least": least})
    flow.add("passed", lambda t: t.withColumn("twice", F.col("k") * 2), "kept", passing=True)
    flow.add("tally", tally, "passed")
    return flow


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_stopped_flow_goes_on_after_its_last_stage(spark, tmp_path, source):
    folder = str(tmp_path / "flow")
    first = declared(spark, folder, source, fail=True)
    with pytest.raises(RuntimeError):
        first.table("tally")
    assert first.made == ["kept", "passed"]
    again = declared(spark, folder, source)
    found = rows(again.table("tally"))
    assert found == [(3, 14), (4, 14), (5, 14), (6, 14)]
    assert again.made == ["tally"] and again.reused == ["passed"]
    assert again.counts == {"passed": 56, "tally": 4}
    assert [name.split("-")[0] for name in again.finish()] == ["passed"]
    third = declared(spark, folder, source)
    assert rows(third.table("tally")) == found
    # The passing stage is gone, and nothing that is asked for needs it.
    assert third.made == [] and third.reused == ["tally"]


def test_a_failed_write_commits_nothing(spark, tmp_path, source):
    folder = str(tmp_path / "flow")
    flow = Flow(spark, folder)
    flow.add("broken", lambda t: t.select(F.raise_error(F.lit("no")).alias("x")), spark.read.parquet(source))
    with pytest.raises(Exception, match="no"):
        flow.table("broken")
    assert not flow.committed("broken")
    mended = Flow(spark, folder)
    mended.add("broken", lambda t: t.select("id"), spark.read.parquet(source))
    assert mended.table("broken").count() == 100
    mended.finish()
    assert not [name for name in os.listdir(folder) if ATTEMPT in name]


def test_changes_make_what_depends_on_them(spark, tmp_path, source):
    folder = str(tmp_path / "flow")
    declared(spark, folder, source).table("tally")
    other = declared(spark, folder, source, least=5)
    assert rows(other.table("tally")) == [(5, 14), (6, 14)]
    assert other.made == ["kept", "passed", "tally"]
    spark.range(7).withColumn("k", F.col("id") % 7).write.mode("append").parquet(source)
    more = declared(spark, folder, source, least=5)
    assert rows(more.table("tally")) == [(5, 15), (6, 15)]
    assert len(more.finish(superseded=True)) == 7
    assert sorted(n.split("-")[0] for n in os.listdir(folder)) == ["kept", "tally"]


def test_the_first_of_two_runs_stays(spark, tmp_path, source):
    folder = str(tmp_path / "flow")
    one, two = declared(spark, folder, source), declared(spark, folder, source)
    one.table("kept")
    before = sorted(os.listdir(one.path("kept")))
    two._write("kept", spark.read.parquet(source))
    assert sorted(os.listdir(one.path("kept"))) == before and two.table("kept").count() == 56
    assert len(os.listdir(folder)) == 1


def test_what_cannot_be_declared(spark, tmp_path, source):
    flow = Flow(spark, str(tmp_path / "flow"))
    with pytest.raises(ValueError, match="without files"):
        flow.add("a", lambda t: t, spark.range(3))
    with pytest.raises(ValueError, match="not declared"):
        flow.add("a", lambda t: t, "b")
    flow.add("a", lambda t: t, spark.read.parquet(source))
    for name in ("a", "a-b", ""):
        with pytest.raises(ValueError, match="plain name"):
            flow.add(name, lambda t: t, spark.read.parquet(source))
    empty = Flow(spark, str(tmp_path / "empty"))
    empty.add("none", lambda t: t.where("false"), spark.read.parquet(source))
    assert empty.table("none").columns == ["id", "k"] and empty.counts == {"none": 0}
