"""Joins between comments, submissions, labels, scores and rates.

No join carries a broadcast hint: the planner broadcasts a side whose size it
knows to be small, adaptive execution does so once it has measured the side,
and beyond that limit the join is a sort-merge join whose skewed partitions are
split at run time. ``link_join`` can also salt.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import hash_bucket, link_key
from opinara.operators.rates import tally


def attach_labels(
    comments: DataFrame, labels: DataFrame, on: tuple[str, str] = ("id", "iid")
) -> DataFrame:
    """Comments with their labels; an id that occurs twice on a side fans out."""
    left, right = on
    return comments.join(labels, F.col(left) == F.col(right), "inner")


def link_join(
    comments: DataFrame, submissions: DataFrame, prefix: str = "t3_", salts: int = 1
) -> DataFrame:
    """Comments with the submission they belong to, by the prefixed key.

    ``salts`` above 1 spreads the comments of each submission over that many
    shuffle keys and copies every submission to each of them, for a session
    that does not split skewed partitions itself.
    """
    keyed = submissions.withColumn("_link", link_key(F.col("sub_id"), prefix))
    if salts <= 1:
        return comments.join(keyed, F.col("link_id") == F.col("_link"), "inner").drop("_link")
    salted = comments.withColumn("_salt", hash_bucket(F.col("id"), salts))
    copies = keyed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    matched = (F.col("link_id") == F.col("_link")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, matched, "inner").drop("_link", "_salt", "_copy")


def linked_tally(
    scored: DataFrame, submissions: DataFrame, measures: Mapping[str, str], prefix: str = "t3_"
) -> DataFrame:
    """Each submission with the tallied flags of its comments."""
    return link_join(tally(scored, ["link_id"], measures), submissions, prefix)


def rejoin_scores(
    scored: DataFrame, comments: DataFrame, submissions: DataFrame, prefix: str = "t3_"
) -> DataFrame:
    """Scored ids with the comment's and the submission's score.

    Takes ``scored`` (id, flags), ``comments`` (com_id, link_id, com_score) and
    ``submissions`` (sub_id, sub_score).
    """
    with_comment = scored.join(comments, F.col("id") == F.col("com_id"), "inner")
    return link_join(with_comment, submissions, prefix)


def in_table(df: DataFrame, col: str, lookup: DataFrame, key: str | None = None) -> DataFrame:
    """Rows whose value stands in the lookup table, each once."""
    keys = lookup.select(F.col(key or col).alias("_key"))
    return df.join(keys, F.col(col) == F.col("_key"), "left_semi")


def join_rates(pos: DataFrame, neg: DataFrame, key: str, null_safe: bool = True) -> DataFrame:
    """Two rate tables side by side; by default a missing key matches itself."""
    right = neg.withColumnRenamed(key, "_key")
    same = F.col(key).eqNullSafe(F.col("_key")) if null_safe else F.col(key) == F.col("_key")
    return pos.join(right, same, "inner").drop("_key")
