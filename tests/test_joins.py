from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.operators import joins
from opinara.operators.rates import (
    compare_subset,
    compare_subset_of_tally,
    rates,
    rates_of_tally,
)
from opinara.operators.report import BOTH


@pytest.fixture
def no_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_labels_fan_out(spark):
    comments = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "id string, body string")
    labels = spark.createDataFrame([("a", "1"), ("a", "0"), ("c", "1")], "iid string, label string")
    joined = joins.attach_labels(comments, labels)
    assert sorted((r.body, r.label) for r in joined.collect()) == [
        ("x", "0"), ("x", "1"), ("y", "0"), ("y", "1"),
    ]


def _hot_comments(spark, n=30_000):
    """A third of the comments belong to one submission."""
    link = F.when(F.col("id") % 3 == 0, F.lit("t3_hot")).otherwise(
        F.concat(F.lit("t3_"), F.col("id") % 500)
    )
    return spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("id"),
        link.alias("link_id"),
        F.md5(F.col("id").cast("string")).alias("body"),
    )


def _submissions(spark):
    rows = [("hot", "hot title", 1)] + [(str(i), f"title {i}", i) for i in range(450)]
    return spark.createDataFrame(rows, "sub_id string, title string, sub_score long")


def _expected(n=30_000):
    return sum(1 for i in range(n) if i % 3 == 0 or i % 500 < 450)


def test_hot_submission_is_split_at_run_time(spark, no_broadcast):
    joined = joins.link_join(_hot_comments(spark), _submissions(spark))
    assert len(joined.collect()) == _expected()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_salted_join_gives_the_same_rows(spark, no_broadcast):
    plain = joins.link_join(_hot_comments(spark), _submissions(spark))
    salted = joins.link_join(_hot_comments(spark), _submissions(spark), salts=16)
    assert salted.columns == plain.columns
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_tallied_join_gives_the_rates_of_the_rows(spark):
    """Also where a submission occurs twice and where a flag is missing."""
    scored = _hot_comments(spark).select(
        "link_id",
        F.when(F.col("id") % 7 != 0, (F.col("id") % 2).cast("double")).alias("pos"),
        (F.col("id") % 5 == 0).cast("double").alias("neg"),
    )
    twice = _submissions(spark).union(_submissions(spark).where("sub_id IN ('hot', '3')"))
    keys = [F.length("title").alias("n")]
    rows = rates(joins.link_join(scored, twice), keys, BOTH, support="support")
    tallied = joins.linked_tally(scored, twice, BOTH)
    from_tally = rates_of_tally(tallied, keys, BOTH, support="support")
    assert set(map(tuple, rows.collect())) == set(map(tuple, from_tally.collect()))
    hot = F.contains("title", F.lit("hot"))
    assert (
        compare_subset(joins.link_join(scored, twice), hot, BOTH).first()
        == compare_subset_of_tally(tallied, hot, BOTH).first()
    )


def test_small_submissions_are_broadcast(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    turns = spark.read.parquet(path).withColumnRenamed("text", "title")
    submissions = turns.where("turn = 0").select(F.col("conv_id").cast("string").alias("sub_id"))
    joined = joins.link_join(_hot_comments(spark), submissions)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_rejoin_scores(spark):
    scored = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "id string, pos double")
    comments = spark.createDataFrame(
        [("a", "t3_1", 4), ("b", "t3_9", 5)], "com_id string, link_id string, com_score long"
    )
    submissions = spark.createDataFrame([("1", 7)], "sub_id string, sub_score long")
    rows = joins.rejoin_scores(scored, comments, submissions).collect()
    assert [(r.id, r.pos, r.com_score, r.sub_score) for r in rows] == [("a", 1.0, 4, 7)]


def test_in_table_does_not_fan_out(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "state string, n int")
    lookup = spark.createDataFrame([("x",), ("x",)], "name string")
    kept = joins.in_table(df, "state", lookup, "name").collect()
    assert [tuple(r) for r in kept] == [("x", 1)]


def test_join_rates_and_missing_keys(spark):
    pos = spark.createDataFrame([("a", 0.1), (None, 0.2)], "state string, positive double")
    neg = spark.createDataFrame([("a", 0.3), (None, 0.4)], "state string, negative double")
    both = {tuple(r) for r in joins.join_rates(pos, neg, "state").collect()}
    assert both == {("a", 0.1, 0.3), (None, 0.2, 0.4)}
    strict = joins.join_rates(pos, neg, "state", null_safe=False).collect()
    assert [tuple(r) for r in strict] == [("a", 0.1, 0.3)]
