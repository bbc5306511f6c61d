import json

import pytest
from pyspark.sql import functions as F

from opinara import sources
from opinara.plans.standins import spread
from opinara.session import materialise, shared_dir
from opinara.sources import schemas


def test_json_lines_with_the_declared_schema(spark, tmp_path):
    path = tmp_path / "comments.json"
    rows = [
        {"id": "a", "body": "two\nlines", "score": 3, "created_utc": 5, "extra": True},
        {"id": "b", "body": None, "link_id": "t3_x", "author_flair_text": "Ohio"},
    ]
    path.write_text("\n".join(map(json.dumps, rows)))
    found = sources.read_comments(spark, str(path))
    assert found.schema == schemas.COMMENTS
    assert [tuple(r) for r in found.orderBy("id").collect()] == [
        ("a", "two\nlines", None, 5, None, 3), ("b", None, "t3_x", None, "Ohio", None),
    ]


def test_bzip2_json_lines(spark, tmp_path):
    path = str(tmp_path / "submissions")
    rows = spark.createDataFrame([("a", "Title", 1), ("b", None, None)], schemas.SUBMISSIONS)
    sources.write_json_lines(rows, path)
    assert list((tmp_path / "submissions").glob("*.json.bz2"))
    assert sorted(map(tuple, sources.read_submissions(spark, path).collect())) == [
        ("a", "Title", 1), ("b", None, None),
    ]


def test_parquet_submissions(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("a", "Title", 1)], schemas.SUBMISSIONS)
    sources.write_table(rows, path)
    assert sources.read_submissions(spark, path, "parquet").collect() == rows.collect()
    with pytest.raises(Exception, match="already exists"):
        sources.write_table(rows, path)
    with pytest.raises(ValueError):
        sources.read_submissions(spark, path, "xml")


def test_label_csv_stays_text(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("Input_id,labeldem,labelgop,labeldjt\na,1,0,-1\nb,,x,1\n")
    assert [tuple(r) for r in sources.read_labels(spark, str(path)).collect()] == [
        ("a", "1", "0", "-1"), ("b", None, "x", "1"),
    ]
    other = tmp_path / "labels.tsv"
    other.write_text("Input_id\tlabeldem\tlabelgop\tlabeldjt\na\t1\t0\t-1\n")
    assert sources.read_labels(spark, str(other), "\t").count() == 1


def test_label_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("n,Input_id,labelgop,labeldem,labeldjt\n0,a,GOP,DEM,DJT\n")
    assert sources.read_labels(spark, str(path)).first() == ("a", "DEM", "GOP", "DJT")
    path.write_text("Input_id,labelgop\na,1\n")
    with pytest.raises(ValueError, match="labeldem"):
        sources.read_labels(spark, str(path))


def test_quoted_numbers_and_bad_lines(spark, tmp_path):
    path = tmp_path / "comments.json"
    path.write_text('{"id": "a", "score": "7", "created_utc": "1430438400"}\n')
    found = sources.read_comments(spark, str(path)).first()
    assert (found.score, found.created_utc) == (7, 1430438400)
    path.write_text('{"id": "a", "score": "x"}\n{"id": "b"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_comments(spark, str(path)).collect()
    found = sources.read_comments(spark, str(path), mode="PERMISSIVE", corrupt="bad").cache()
    assert sorted((r.id or "", r.score, r.bad) for r in found.collect()) == [
        ("", None, '{"id": "b"'), ("a", None, None),
    ]


def test_report_csv_has_a_header(spark, tmp_path):
    path = tmp_path / "report"
    rows = [("2018-01-01", 0.25), ("2018-01-01", 0.75)]
    scored = spark.createDataFrame(rows, "date string, positive double")
    report = scored.groupBy("date").agg(F.avg("positive").alias("positive")).orderBy("date")
    sources.write_report_csv(report, str(path))
    text = "".join(part.read_text() for part in path.glob("*.csv"))
    assert text == "date,positive\n2018-01-01,0.5\n"


def test_partitioned_write_gathers_each_key(spark, tmp_path):
    path = tmp_path / "by_day"
    rows = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 3).alias("day"))
    sources.write_table(rows, str(path), partition_by=["day"])
    assert [len(list(day.glob("*.parquet"))) for day in path.glob("day=*")] == [1, 1, 1]
    assert sources.read_table(spark, str(path)).where("day = 1").count() == 333


def test_materialise_writes_to_the_shared_folder(spark):
    written = materialise(spark.range(10), "numbers")
    assert written.inputFiles()[0].startswith(("file:", "/"))
    assert shared_dir(spark).removeprefix("file:") in written.inputFiles()[0]
    assert written.count() == 10


class Cluster:
    """What ``shared_dir`` asks of a session."""

    def __init__(self, named, known, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: known


def test_shared_folder_is_the_cluster_s():
    assert shared_dir(Cluster("hdfs:///shared/", None, "yarn")) == "hdfs:///shared"
    assert shared_dir(Cluster(None, "hdfs:///set/in/code", "yarn")) == "hdfs:///set/in/code"
    with pytest.raises(ValueError):
        shared_dir(Cluster(None, None, "yarn"))


def test_spread_leaves_tables_with_enough_parts(spark):
    cores = spark.sparkContext.defaultParallelism
    enough, few = spark.range(0, 100, 1, cores), spark.range(0, 100, 1, 1)
    assert spread(enough) is enough
    assert spread(few).rdd.getNumPartitions() == cores
