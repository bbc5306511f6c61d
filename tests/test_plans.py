import re

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from opinara.operators import evaluate, prep
from opinara.operators.models import POSITIVE
from opinara.operators.words import with_words
from opinara.plans import flows, standins

SF_DIR = "/root/testdata/sf0.001"
# Windows inside ranges of scores, and over one row for each range.
RANGE_WINDOWS = {
    "eval_auc", "eval_auc_by_source", "eval_auc_ties", "eval_roc_corners", "eval_roc_corners_ties", "eval_roc_points",
    "ml_cross_validate", "ml_evaluate", "ml_grid", "op3_mixing", "rpt_roc", "rpt_roc_models",
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_rows_equal_the_sql(spark, connection, name):
    problem = compare(spark, connection, queries()[name], oracle_sql()[name], SF_DIR)
    assert not problem


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_without_sql(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["state", "positive", "negative", "n_tokens"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_plans_stay_in_the_jvm_and_parallel(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in RANGE_WINDOWS:
        assert "Window " not in plan
    # What meets in one task has been aggregated before.
    for line, below in re.findall(r"(Exchange SinglePartition.*)\n(.*)", plan):
        assert "Aggregate" in below or "Window" in plan, line


def test_marks_are_filtered_in_the_scan(spark):
    comments = standins.comments(spark, SF_DIR)
    plan = plan_of(prep.drop_marked(comments).select("id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "Not(StringContains(text,&gt;))" in pushed
    assert "Not(StringContains(text,/s))" in pushed


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(queries()["rate_by_submission_score"](spark, SF_DIR))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_text_is_normalised_once(spark):
    words = with_words(standins.comments(spark, SF_DIR))
    assert plan_of(words).count("https?") == 1
    assert plan_of(words.where(F.array_size("words") > 3)).count("https?") == 1
    assert plan_of(words.where("size(words) > 3").select(F.explode("words"))).count("https?") == 1
    assert plan_of(queries()["sql_functions"](spark, SF_DIR)).count("https?") == 1


def test_a_filter_on_flags_scores_once(spark):
    comments = standins.threads(spark, SF_DIR)
    labels = comments.select("id", F.col("id").alias("iid"), F.lit("1").alias("Trump"))
    texts = flows.labelled_words(comments, labels.drop("id"))
    mixed = texts.withColumn("poslabel", (F.length("id") % 2).cast("int"))
    fitted, _ = flows.train_models(mixed, {"pos": POSITIVE}, folds=0)
    documents = standins.comments(spark, SF_DIR)
    plan = plan_of(flows.flag_comments(documents, fitted).where("pos = 1").select("id"))
    assert plan.count("https?") == 1
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "Not(StringContains(text,&gt;))" in pushed
    assert "source" not in plan.rsplit("ReadSchema", 1)[1]


def test_scores_are_counted_before_they_are_ranked(spark):
    orders = standins.table(spark, SF_DIR, "orders").withColumn("y", F.lit(1))
    plan = plan_of(evaluate.roc(orders, "o_totalprice", "y"))
    assert "orders.parquet" not in plan
