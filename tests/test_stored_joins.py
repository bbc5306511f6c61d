import re

import pytest
from pyspark.sql import functions as F

from opinara.operators.joins import attach_labels, link_join
from opinara.operators.late import attach_labels_late, id_ranges, matched_ids, within
from opinara.operators.stored_links import linked, open_stored, store_comments, store_submissions

BUCKETS = 6


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def tables(spark):
    """Half of the comments hang on one submission; some on none, some on one that is not there."""
    n = spark.range(4000).withColumn("k", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 97))
    link = F.when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("t3_"), F.col("k")))
    comments = n.select(F.col("id").cast("string"), link.alias("link_id"), (F.col("id") % 11).alias("com_score"))
    twice = spark.range(90).union(spark.range(5, 8))  # some submissions stand twice
    submissions = twice.select(F.col("id").cast("string").alias("sub_id"), F.concat(F.lit("title "), "id").alias("title"))
    return comments, submissions


@pytest.fixture
def unbroadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def stored(tables, folder):
    comments, submissions = f"{folder}/comments", f"{folder}/submissions"
    store_comments(tables[0], comments, BUCKETS)
    store_submissions(tables[1], submissions, comments)
    return comments, submissions


def test_stored_tables_join_without_a_shuffle(spark, tables, tmp_path, unbroadcast):
    paths = stored(tables, tmp_path)
    found = linked(spark, *paths)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows(found) == rows(link_join(*tables))


def test_a_hot_submission_is_split(spark, tables, tmp_path, unbroadcast):
    paths = stored(tables, tmp_path)
    parts = linked(spark, *paths).groupBy(F.spark_partition_id()).count().collect()
    total = sum(r["count"] for r in parts)
    assert max(r["count"] for r in parts) < total / 2
    whole = open_stored(spark, paths[0])
    assert whole.where("link_id = 't3_7'").select("_part").distinct().count() > 4
    assert whole.count() == 4000
    by_file = whole.groupBy(F.input_file_name()).count().collect()
    assert len(by_file) <= BUCKETS and max(r["count"] for r in by_file) < 2000


def test_a_later_session_knows_the_layout(spark, tables, tmp_path, unbroadcast):
    paths = stored(tables, tmp_path)
    for path in paths:
        name = re.search(r"stored_\w+", open_stored(spark, path)._jdf.queryExecution().analyzed().toString()).group()
        spark.sql(f"DROP TABLE {name}")
    found = linked(spark, *paths)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(link_join(*tables))


def test_empty_sides(spark, tables, tmp_path):
    comments, submissions = tables
    assert linked(spark, *stored((comments.where("false"), submissions), tmp_path / "a")).count() == 0
    assert linked(spark, *stored((comments, submissions.where("false")), tmp_path / "b")).count() == 0


def test_layouts_must_agree(spark, tables, tmp_path):
    one = stored(tables, tmp_path / "a")
    store_comments(tables[0], str(tmp_path / "other"), BUCKETS + 1)
    with pytest.raises(ValueError, match="same buckets"):
        linked(spark, str(tmp_path / "other"), one[1])
    with pytest.raises(ValueError, match="_part"):
        store_comments(tables[0].withColumn("_part", F.lit(1)), str(tmp_path / "c"), 2)


def test_a_hot_key_of_another_layout_is_refused(spark, tables, tmp_path):
    """Submissions stored for comments without a hot key would lose links of one."""
    even = tables[0].where("link_id <> 't3_7'")
    one, other = stored((even, tables[1]), tmp_path / "a"), stored(tables, tmp_path / "b")
    with pytest.raises(ValueError, match="these comments"):
        linked(spark, other[0], one[1])


# Labels first, bodies late


@pytest.fixture
def bodies(spark, tmp_path):
    """Ids in order, in row groups of some hundred rows."""
    ids = spark.range(20000).select(F.format_string("id%06d", "id").alias("id"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("body"))
    path = str(tmp_path / "bodies")
    ids.coalesce(1).write.option("parquet.block.size", 128 * 1024).option("parquet.page.row.count.limit", 200).parquet(path)
    return spark.read.parquet(path)


def rows_out_of_the_scan(df):
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_row_groups_without_labelled_ids_are_skipped(spark, bodies):
    labels = spark.createDataFrame([(f"id{i:06d}", i) for i in (3, 4, 9000, 9001, 19990)], "iid string, label int")
    bounds = id_ranges(matched_ids(bodies, labels, ("id", "iid")), "id")
    assert 1 <= len(bounds) <= 5
    scan = bodies.where(within(F.col("id"), bounds))
    assert "PushedFilters: [Or(" in scan._jdf.queryExecution().executedPlan().toString()
    assert rows_out_of_the_scan(scan) < 20000 / 3
    assert rows(attach_labels_late(bodies, labels)) == rows(attach_labels(bodies, labels))


def test_many_labels_and_few_ranges(spark, bodies):
    labels = spark.range(0, 30000, 7).select(F.format_string("id%06d", "id").alias("iid"), (F.col("id") % 3).alias("label"))
    again = labels.union(labels.limit(5)).union(labels.select(F.lit(None).cast("string").alias("iid"), "label").limit(2))
    found = attach_labels_late(bodies, again, ranges=8)
    assert rows(found) == rows(attach_labels(bodies, again))
    assert len(id_ranges(labels, "iid", 8)) <= 8


def test_no_labels(spark, bodies):
    labels = spark.createDataFrame([], "iid string, label int")
    found = attach_labels_late(bodies, labels)
    assert found.columns == ["id", "body", "iid", "label"] and found.count() == 0
