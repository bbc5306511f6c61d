"""Comments and submissions stored by link key, so that joining them shuffles neither.

``store_comments`` writes comments in buckets of their link key, each sorted, and
``store_submissions`` writes submissions in the same buckets; ``linked`` joins the two
where they lie. The cost of the shuffle is paid once, when the tables are stored.

A bucket is one task's work, so a submission with a third of all comments would be one
task. Keys with more comments than half of a bucket's even share are spread over buckets
by the comment's id, and their submission is stored once for each part. There are at most
``2 * buckets`` such keys and, over all keys, ``4 * buckets`` parts, whatever the comments.

The layout (columns, buckets) is recorded beside each table, since a bucketed table is
known to its session's catalog only; ``open_stored`` declares it in any later session.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import hash_bucket, link_key

PART = "_part"
LAYOUT = "layout"
HOT = "hot"
ROWS = "rows"


def _store(df: DataFrame, path: str, key: str, buckets: int, of: str) -> None:
    spark = df.sparkSession
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    placed = df.repartition(buckets, key, PART)
    name = _declared(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    placed.write.format("parquet").option("path", f"{path}/{ROWS}").bucketBy(buckets, key, PART).sortBy(
        key, PART
    ).saveAsTable(name)
    held = json.dumps({"columns": ddl, "key": key, "buckets": buckets, "of": of})
    # The layout comes last: a table without one is not whole.
    spark.range(1).select(F.lit(held).alias("value")).coalesce(1).write.text(f"{path}/{LAYOUT}")


def _declared(path: str) -> str:
    return f"stored_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def layout(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/{LAYOUT}").first()["value"])


def open_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its buckets, declared in this session if it is not."""
    held, name = layout(spark, path), _declared(path)
    if not spark.catalog.tableExists(name):
        key = held["key"]
        spark.sql(
            f"CREATE TABLE {name} ({held['columns']}) USING parquet OPTIONS (path '{path}/{ROWS}') "
            f"CLUSTERED BY (`{key}`, {PART}) SORTED BY (`{key}`, {PART}) INTO {held['buckets']} BUCKETS"
        )
    return spark.table(name)


def hot_links(comments: DataFrame, buckets: int, link: str = "link_id") -> DataFrame:
    """Keys with more than half of a bucket's even share of rows, and their number of parts."""
    share = comments.count() / (2 * buckets)
    counts = comments.where(F.col(link).isNotNull()).groupBy(link).agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > F.lit(share))
    return hot.select(F.col(link).alias("_hot"), F.ceil(F.col("n") / F.lit(share)).cast("int").alias("_parts"))


def store_comments(
    comments: DataFrame, path: str, buckets: int, link: str = "link_id", id: str = "id"
) -> None:
    """Store comments by link key; a comment without one is stored and joins with nothing."""
    if PART in comments.columns:
        raise ValueError(f"the table has a column {PART}")
    if buckets < 1:
        raise ValueError("there must be a bucket")
    spark = comments.sparkSession
    hot_links(comments, buckets, link).coalesce(1).write.parquet(f"{path}/{HOT}")
    hot = spark.read.parquet(f"{path}/{HOT}")
    parted = comments.join(F.broadcast(hot), F.col(link) == F.col("_hot"), "left")
    # A bucket number below the parts of the key, or 0; rows without a key are spread too.
    most = F.when(F.col(link).isNull(), buckets).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(hash_bucket(F.col(id), 1 << 30), most).cast("int")
    _store(parted.withColumn(PART, part).drop("_hot", "_parts"), path, link, buckets, uuid.uuid4().hex)


def store_submissions(
    submissions: DataFrame, path: str, comments_path: str, id: str = "sub_id", prefix: str = "t3_"
) -> None:
    """Store submissions in the buckets of the comments at ``comments_path``."""
    if taken := {PART, "_link"} & set(submissions.columns):
        raise ValueError(f"the table has columns {sorted(taken)}")
    spark = submissions.sparkSession
    hot = spark.read.parquet(f"{comments_path}/{HOT}")
    keyed = submissions.withColumn("_link", link_key(F.col(id), prefix))
    parted = keyed.join(F.broadcast(hot), F.col("_link") == F.col("_hot"), "left")
    last = F.coalesce("_parts", F.lit(1)) - 1
    copies = parted.withColumn(PART, F.explode(F.sequence(F.lit(0), last)))
    held = layout(spark, comments_path)
    _store(copies.drop("_hot", "_parts"), path, "_link", held["buckets"], held["of"])


def linked(spark: SparkSession, comments_path: str, submissions_path: str) -> DataFrame:
    """Stored comments with their submissions, joined bucket by bucket without a shuffle.

    Needs submissions stored by these comments' layout; equal to ``link_join``'s rows.
    """
    left, right = layout(spark, comments_path), layout(spark, submissions_path)
    if left["buckets"] != right["buckets"]:
        raise ValueError("the tables are not stored in the same buckets")
    # Another table's hot keys have other parts, and links would be lost.
    if left["of"] != right["of"]:
        raise ValueError("the submissions were not stored for these comments")
    comments = open_stored(spark, comments_path)
    submissions = open_stored(spark, submissions_path).withColumnRenamed(PART, "_copy")
    same = (F.col(left["key"]) == F.col("_link")) & (F.col(PART) == F.col("_copy"))
    # Merged, not broadcast: the sides lie sorted by bucket.
    return comments.hint("merge").join(submissions, same, "inner").drop(PART, "_copy", "_link")
