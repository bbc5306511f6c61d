"""ROC curve and the area under it, exact and distributed.

Rows are first counted by distinct score. The running counts over those scores
need no window over the whole table: the scores are cut into ranges, the ranges'
totals are summed up in score order, and each range then runs its own window
starting from the sum before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.operators.ranges import in_ranges, with_sums_before
from opinara.session import materialise


def score_label(df: DataFrame, score: str, label: str) -> DataFrame:
    """The evaluation input: score and 0/1 label as doubles."""
    return df.select(
        F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label")
    )


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """The classes' counts by distinct score, written to the shared folder.

    Ranges, totals and running counts all start here, so that the table itself
    is read once.
    """
    pairs = score_label(df, score, label).where(F.col("score").isNotNull())
    counted = pairs.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )
    return materialise(counted, "scores")


def _running_counts(by_score: DataFrame, ranges: int | None) -> DataFrame:
    """Per distinct score the classes' counts at or above it, and the totals; NaN is highest."""
    placed = in_ranges(by_score, [F.desc("score")], "score_ranges", ranges)
    inside = (
        Window.partitionBy("_range")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return with_sums_before(placed, {"n_pos": F.sum("pos"), "n_neg": F.sum("neg")}).select(
        "score",
        "pos",
        "neg",
        F.col("n_pos_total").alias("n_pos"),
        F.col("n_neg_total").alias("n_neg"),
        (F.col("n_pos_before") + F.sum("pos").over(inside)).alias("pos_reached"),
        (F.col("n_neg_before") + F.sum("neg").over(inside)).alias("neg_reached"),
    )


def roc(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """Every point of the curve, from (0, 0) with no threshold down to (1, 1)."""
    by_score = _by_score(df, score, label)
    reached = _running_counts(by_score, ranges)
    points = reached.select(
        F.col("score").alias("threshold"),
        (F.col("neg_reached") / F.nullif("n_neg", F.lit(0))).alias("fpr"),
        (F.col("pos_reached") / F.nullif("n_pos", F.lit(0))).alias("tpr"),
    )
    start = by_score.agg(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return start.unionByName(points)


def auc(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """One row with the area under the curve; NULL if a class is missing.

    The area is the share of positive-negative pairs that the score ranks
    right, ties counting half. Twice the pair count is an integer, so it is
    summed as a decimal and does not depend on the order of summation.
    """
    reached = _running_counts(_by_score(df, score, label), ranges)
    whole = "decimal(19,0)"
    below = F.col("n_neg") - F.col("neg_reached")
    twice = F.col("pos").cast(whole) * (2 * below + F.col("neg")).cast(whole)
    pairs = F.max("n_pos").cast("double") * F.max("n_neg").cast("double")
    return reached.agg(
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        (F.sum(twice).cast("double") / F.nullif(F.lit(2.0) * pairs, F.lit(0.0))).alias("auc"),
    )


def areas(df: DataFrame, key: str, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """``auc`` for each value of ``key``: one ranking for all, in order of key and score.

    The counts reached within a key are those reached at all less those of the keys
    before it, so a key with most of the rows is ranked in as many ranges as it fills.
    """
    pairs = df.select(
        key, F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label")
    ).where(F.col("score").isNotNull())
    counted = pairs.groupBy(key, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    order = [F.asc_nulls_first(key), F.desc("score")]
    placed = in_ranges(materialise(counted, "scores"), order, "score_ranges", ranges)
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = with_sums_before(placed, {"n_neg": F.sum("neg")}).select(
        key, "pos", "neg", (F.col("n_neg_before") + F.sum("neg").over(inside)).alias("neg_reached")
    )
    # A pair counts for each positive and each negative below it; twice, so that ties are whole.
    whole = "decimal(19,0)"
    summed = reached.groupBy(key).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.max("neg_reached").alias("neg_end"),
        F.sum(F.col("pos").cast(whole) * (F.col("neg") - 2 * F.col("neg_reached")).cast(whole)).alias("twice"),
    )
    # With the counts up to the key's end, what is reached before it cancels out.
    twice = F.col("twice") + F.col("n_pos").cast(whole) * (2 * F.col("neg_end")).cast(whole)
    pairs_of = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return summed.select(
        key, "n_pos", "n_neg", (twice.cast("double") / F.nullif(F.lit(2.0) * pairs_of, F.lit(0.0))).alias("auc")
    )


def roc_corners(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """The curve's points without those where it goes on as before, from (0, 0) at infinity.

    A point is left out if the step to it and the step from it add as many of either
    class. Only the next lower score is looked at; for the last one of a range that is the
    first of the next range, of which there is one row each. The first and last
    scores stay.
    """
    placed = in_ranges(_by_score(df, score, label), [F.desc("score")], "score_ranges", ranges)
    by_range = Window.partitionBy("_range").orderBy(F.desc("score"))
    inside = by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.struct("pos", "neg")
    firsts = placed.groupBy("_range").agg(F.max_by(step, "score").alias("first"))
    over_ranges = Window.orderBy("_range")  # one row for each range
    borders = firsts.select(
        F.col("_range").alias("_own"),
        F.lead("first").over(over_ranges).alias("next_first"),
        (F.row_number().over(over_ranges) == 1).alias("leads"),
    )
    counted = with_sums_before(placed, {"n_pos": F.sum("pos"), "n_neg": F.sum("neg")})
    joined = counted.join(F.broadcast(borders), F.col("_range") == F.col("_own"))
    reached = joined.select(
        "score",
        "n_pos_total",
        "n_neg_total",
        (F.col("n_pos_before") + F.sum("pos").over(inside)).alias("pos_reached"),
        (F.col("n_neg_before") + F.sum("neg").over(inside)).alias("neg_reached"),
        step.alias("step"),
        F.coalesce(F.lead(step).over(by_range), F.col("next_first")).alias("next_step"),
        (F.col("leads") & (F.row_number().over(by_range) == 1)).alias("is_first"),
    )
    kept = reached.where(F.col("is_first") | ~F.col("step").eqNullSafe(F.col("next_step")))
    points = kept.select(
        F.col("score").alias("threshold"),
        (F.col("neg_reached") / F.nullif("n_neg_total", F.lit(0))).alias("fpr"),
        (F.col("pos_reached") / F.nullif("n_pos_total", F.lit(0))).alias("tpr"),
    )
    infinite = F.lit(float("inf")).alias("threshold")
    start = placed.agg(F.count(F.lit(1))).select(infinite, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def auc_from_histogram(
    df: DataFrame, score: str, label: str, low: float, high: float, bins: int = 1024
) -> DataFrame:
    """The area from one pass, ``n_pos, n_neg, auc, bound``, off by ``bound`` at most.

    Both classes are counted in ``bins`` equal parts of ``low`` to ``high``, scores
    beyond them in the first or last and NaN, the highest score, in the last. Counts
    merge, so tasks send ``bins`` rows at most and nothing is ranked or written. Pairs
    of different bins are judged as they are; those within a bin count half, which is
    off by half of them at most.
    """
    value = F.col(score).cast("double")
    share = (value - F.lit(float(low))) / F.lit(float(high) - float(low)) * F.lit(float(bins))
    inside = F.greatest(F.least(F.floor(share), F.lit(bins - 1)), F.lit(0))
    at = F.when(F.isnan(value) | (value >= F.lit(float(high))), F.lit(bins - 1)).when(value < F.lit(float(low)), F.lit(0))
    y = F.col(label).cast("double")
    counted = df.where(F.col(score).isNotNull()).groupBy(at.otherwise(inside).cast("int").alias("bin")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    whole = "decimal(38,0)"
    rows = F.sort_array(F.collect_list(F.struct("bin", "pos", "neg")))  # `bins` of them at most
    nothing = F.lit(0).cast(whole)

    def add(sums, row):
        pos, neg = row["pos"].cast(whole), row["neg"].cast(whole)
        return F.struct(
            (sums["below"] + neg).cast(whole).alias("below"),
            (sums["twice"] + pos * (2 * sums["below"] + neg)).cast(whole).alias("twice"),
            (sums["open"] + pos * neg).cast(whole).alias("open"),
        )

    folded = F.aggregate(rows, F.struct(nothing.alias("below"), nothing.alias("twice"), nothing.alias("open")), add)
    held = counted.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), folded.alias("sums")
    )
    pairs = F.nullif(F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double"), F.lit(0.0))
    return held.select(
        "n_pos", "n_neg", (F.col("sums.twice").cast("double") / pairs).alias("auc"), (F.col("sums.open").cast("double") / pairs).alias("bound")
    )
