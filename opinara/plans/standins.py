"""The test tables in the roles of comments, submissions, labels and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import epoch_date, link_key
from opinara.sources import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a test table that comes in fewer parts than there are cores.

    Each test table is a file of one row group, which no split size divides, and the
    text stage is bound by the processor. Tables of many files are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a time without zone, read as UTC."""
    return (
        F.unix_date(F.to_date(ts)).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments: the source stands for the author's flair."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("body"),
        F.col("source").alias("author_flair_text"),
    )


def marked_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as comments, some with a quote, a sarcasm mark, such a URL or no text."""
    text, turn = F.col("body"), F.col("id").cast("long") % 7
    body = (
        F.when(turn == 0, F.concat(F.lit("&gt; they said\n\n"), text))
        .when(turn == 1, F.concat(text, F.lit(" /s")))
        .when(turn == 2, F.concat(F.lit("see https://example.org/story "), text))
        .when(turn == 3, F.lit(None).cast("string"))
        .when(turn == 4, F.concat(text, F.lit(" > &gt")))
        .otherwise(text)
    )
    return comments(spark, sf_dir).withColumn("body", body)


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns of a conversation as comments on its first turn."""
    turns = table(spark, sf_dir, "conversations").where(F.col("turn") > 0)
    return turns.select(
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("body"),
        link_key(F.col("conv_id")).alias("link_id"),
        F.col("role").alias("author_flair_text"),
        F.col("turn").alias("com_score"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turns of conversations: text as title, its length as score."""
    turns = table(spark, sf_dir, "conversations").where(F.col("turn") == 0)
    return turns.select(
        F.col("conv_id").cast("string").alias("sub_id"),
        F.col("text").alias("title"),
        F.length("text").cast("long").alias("sub_score"),
    )


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as text; the opinion is -1, 1 or something that is no number."""
    opinion = (
        F.when(F.col("toxic") == 1, F.lit("-1"))
        .when(F.col("quality") == 1, F.lit("1"))
        .otherwise(F.lit("none"))
    )
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("Input_id"),
        F.col("quality").cast("string").alias("labeldem"),
        F.col("toxic").cast("string").alias("labelgop"),
        opinion.alias("labeldjt"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with quality and toxicity as the two flags."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("quality").cast("double").alias("pos"),
        F.col("toxic").cast("double").alias("neg"),
        F.col("source").alias("author_flair_text"),
        F.col("lang"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with purchase and error as the two flags and the value as score."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        _flag(F.col("event_type") == "purchase").alias("pos"),
        _flag(F.col("event_type") == "error").alias("neg"),
        epoch_seconds(F.col("ts")).alias("created_utc"),
        F.floor("value").cast("long").alias("com_score"),
    )


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with returned and accepted as the flags, quantity as score."""
    return table(spark, sf_dir, "lineitem").select(
        _flag(F.col("l_returnflag") == "R").alias("pos"),
        _flag(F.col("l_returnflag") == "A").alias("neg"),
        F.col("l_quantity").cast("long").alias("sub_score"),
    )


def scored_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread comments, without text, flagged by who speaks."""
    return threads(spark, sf_dir).select(
        "id",
        "link_id",
        "com_score",
        _flag(F.col("author_flair_text") == "assistant").alias("pos"),
        _flag(F.length("body") > 300).alias("neg"),
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_events(spark, sf_dir).withColumn("date", epoch_date(F.col("created_utc")))
