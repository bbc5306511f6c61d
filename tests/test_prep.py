import datetime

import pytest
from pyspark.sql import functions as F

from opinara.functions import (
    epoch_date,
    hash_bucket,
    intensity,
    label_value,
    link_key,
    parse_date,
    rate_diff,
    title_matches,
)
from opinara.operators import prep


def values(df, column="id"):
    return sorted((row[column] for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def comments(spark):
    rows = [
        ("c1", "plain text", "t3_s1", 0, "Texas", 5),
        ("c2", "&gt; quoted", "t3_s1", 86399, "texas", 5),
        ("c3", "sure /s", "t3_s2", 86400, None, -3),
        ("c4", "see http://a.b/search", "t3_s2", -1, "Ohio", 0),
        ("c5", None, "t3_s2", 1541030399, "Ohio", None),
        ("c6", "", "t3_none", None, "Ohio", 1),
        ("c1", "same id", None, 1541030400, "Utah", 1),
    ]
    return spark.createDataFrame(
        rows,
        "id string, body string, link_id string, created_utc long, "
        "author_flair_text string, score long",
    )


def test_slim_renames_by_name(comments):
    slim = prep.slim(comments, prep.COMMENT_COLUMNS)
    assert slim.columns == list(prep.COMMENT_COLUMNS.values())


def test_drop_marked(comments):
    assert values(prep.drop_marked(comments)) == ["c1", "c1", "c6"]
    assert values(prep.drop_marked(comments, mode="token")) == ["c1", "c1", "c4", "c6"]
    with pytest.raises(ValueError):
        prep.drop_marked(comments, mode="other")


def test_in_list_is_exact(comments):
    assert values(prep.in_list(comments, "author_flair_text")) == ["c1", "c1", "c4", "c5", "c6"]
    assert len(set(prep.STATES)) == 51


def test_exclude_keys_keeps_missing(comments):
    kept = prep.exclude_keys(comments, "author_flair_text", ["Ohio", "Utah"])
    assert values(kept) == ["c1", "c2", "c3"]


def test_with_flag(comments):
    assert values(prep.with_flag(comments, "score", 5)) == ["c1", "c2"]


def test_one_vs_rest(spark):
    texts = ["1", "0", "-1", "", None, "maybe", " 1 ", "2"]
    labels = spark.createDataFrame([(t,) for t in texts], "label string")
    rows = [tuple(r) for r in prep.one_vs_rest(labels).collect()]
    assert rows == [
        (1, 1, 0), (0, 0, 0), (-1, 0, 1), (None, 0, 0),
        (None, 0, 0), (None, 0, 0), (1, 1, 0), (2, 0, 0),
    ]


def test_epoch_date_is_utc_in_any_session_zone(spark, comments):
    dates = comments.select("created_utc", epoch_date(F.col("created_utc")).alias("d"))
    expected = {
        0: "1970-01-01", 86399: "1970-01-01", 86400: "1970-01-02", -1: "1969-12-31",
        1541030399: "2018-10-31", 1541030400: "2018-11-01", None: None,
    }
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            for row in dates.collect():
                assert (str(row.d) if row.d else None) == expected[row.created_utc]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_date(spark):
    df = spark.createDataFrame([("2018-12-31",), ("no date",), (None,)], "t string")
    parsed = [row.d for row in df.select(parse_date(F.col("t")).alias("d")).collect()]
    assert parsed == [datetime.date(2018, 12, 31), None, None]


def test_small_columns(spark):
    df = spark.createDataFrame([("a", 0.25, 0.75)], "k string, p double, n double")
    row = df.select(
        link_key(F.col("k")).alias("key"),
        rate_diff(F.col("p"), F.col("n")).alias("diff"),
        intensity(F.col("p"), 0.0, 1.0).alias("shade"),
        intensity(F.col("p"), 0.5, 1.0).alias("below"),
        intensity(F.col("p"), 0.0, 0.1).alias("above"),
        intensity(F.col("p"), 0.5, 1.0, clamp=False).alias("raw"),
        intensity(F.lit(None).cast("double"), 0.0, 1.0).alias("missing"),
        label_value(F.lit("7")).alias("seven"),
    ).first()
    assert row[:5] == ("t3_a", 0.5, 0.5, 1.0, 0.0)
    assert row.raw != row.raw and row.missing is None and row.seven == 7


def test_title_matches(spark):
    df = spark.createDataFrame([("trump",), ("Trump",), ("none",), (None,)], "title string")
    title = F.col("title")
    assert values(df.where(title_matches(title, "trump")), "title") == ["trump"]
    assert values(df.where(title_matches(title, "trump", True)), "title") == ["Trump", "trump"]


def test_hash_bucket_depends_on_the_value_only(spark):
    df = spark.range(5000).select(F.col("id"), hash_bucket(F.col("id"), 10, 3).alias("b"))
    again = df.repartition(13).collect()
    assert {r.id: r.b for r in df.collect()} == {r.id: r.b for r in again}
    sizes = [row["count"] for row in df.groupBy("b").count().collect()]
    assert len(sizes) == 10 and min(sizes) > 400
