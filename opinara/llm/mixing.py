"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the schedule takes the van der Corput point of k, which is k's binary
digits mirrored behind the point. Cumulative targets cut [0, 1) into one
interval for each source, and a slot goes to the source whose interval holds its
point, so every stretch of the schedule has close to the target shares. Each
source's documents lie shuffled on a line of words, cut into blocks of equal
numbers of words; its slots, ranked, take its blocks in turn, and begin again
when all are taken. A document is taken as often as the blocks it lies in.

Everything is DataFrame functions. A source may hold most of the rows: positions
on its line are summed by bucket of the shuffle hash first, so no task orders a
whole source.

Sizes count words (runs of other than space, tab, line feed, vertical tab, form
feed, carriage return); a null text has size 0. A null source is a source of its
own, the last. Rows with equal keys are rows of their own; wholly equal rows are
interchangeable. An empty table gives no rows. If no text has words, nothing is
taken. Columns of other names stay in the table but out of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
# Digits of a schedule point, and slots of the schedule over all sources.
POINT_BITS = 40
SLOTS = 1 << 20
# Parts of the shuffle hash that a source's words are summed by before positions are.
BUCKETS = 4096
# Cells of [0, 1) by which slots find the intervals they may lie in.
CELLS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_hash(key: Column) -> Column:
    """60 bits of the key's MD5, the same in other SQL engines."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: float) -> DataFrame:
    """Words to take from each source: ``source, source_no, source_size, target``.

    Weights go to the sources by code point, null last, and repeat. A source
    stops at ``repeats`` times its size, and what it leaves goes to the others by
    weight. Sources in the order of the level at which they fill up make that a
    running sum: the first source whose bound is not below the level that it and
    the later ones would share sets that level, the highest of those that hold;
    the sources before it are full. One row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_level", "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = sources.withColumn("source_no", F.row_number().over(by_name) - 1)
    chosen = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1
    )
    bounded = (
        numbered.withColumn("_weight", chosen)
        .withColumn("_bound", F.lit(float(repeats)) * F.col("source_size"))
        .withColumn("_level", F.col("_bound") / F.col("_weight"))
        .withColumn("_wanted", F.lit(float(share)) * F.sum("source_size").over(everything))
    )
    left = F.col("_wanted") - F.coalesce(F.sum("_bound").over(before), F.lit(0.0))
    reached = bounded.withColumn("_reached", left / F.sum("_weight").over(after))
    level = F.max(F.when(F.col("_level") >= F.col("_reached"), F.col("_reached"))).over(everything)
    target = F.least(F.col("_bound"), F.coalesce(level, F.lit(float("inf"))) * F.col("_weight"))
    return reached.select("source", "source_no", "source_size", target.alias("target"))


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """The source of each slot and its rank there: ``slot, source_no, rank``.

    Both sides meet by cell of [0, 1): an interval is in the cells it touches.
    """
    spark, whole = sources.sparkSession, 1 << POINT_BITS
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("target").over(before) / F.sum("target").over(Window.partitionBy())
    high = F.floor(share * F.lit(float(whole))).cast("long")
    intervals = (
        sources.where(F.col("target") > 0)
        .select("source_no", "target", high.alias("high"))
        .withColumn("low", F.lag("high", 1, 0).over(Window.orderBy("source_no")))
        .where(F.col("high") > F.col("low"))
    )
    width = whole // CELLS
    cells = F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))
    intervals = intervals.select("source_no", "low", "high", F.explode(cells).alias("cell"))
    mirrored = F.reverse(F.lpad(F.bin("id"), POINT_BITS, "0"))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.conv(mirrored, 2, 10).cast("long").alias("point")
    )
    points = points.withColumn("cell", F.expr(f"point div {width}"))
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    found = points.join(intervals, "cell").where(inside).select("slot", "source_no")
    return _ranked(found, slots)


def _ranked(found: DataFrame, slots: int) -> DataFrame:
    """Rank slots within sources, part by part, since a source may have most slots."""
    parts = found.withColumn("_part", F.expr(f"slot div {max(1, slots // 256)}"))
    inside = Window.partitionBy("source_no", "_part").orderBy("slot")
    before = Window.partitionBy("source_no").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("source_no", "_part").agg(F.count("*").alias("_n"))
    bases = counts.select(
        "source_no", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    return (
        parts.withColumn("_own", F.row_number().over(inside) - 1)
        .join(bases, ["source_no", "_part"])
        .select("slot", "source_no", (F.col("_base") + F.col("_own")).alias("rank"))
    )


def positions(sized: DataFrame) -> DataFrame:
    """Add ``position``: the words before a row on its source's shuffled line."""
    bucket = F.expr(f"_hash div {(1 << 60) // BUCKETS}")
    dealt = sized.withColumn("_bucket", bucket)
    order = Window.partitionBy("source_no", "_bucket").orderBy("_hash", "_key", "size")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_n"))
    bases = sums.select(
        "source_no", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    own = F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (
        dealt.withColumn("_own", own)
        .join(bases, ["source_no", "_bucket"])
        .withColumn("position", F.col("_base") + F.col("_own"))
        .drop("_own", "_base", "_bucket", "_hash")
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MOST_REPEATS,
    slots: int = SLOTS,
) -> DataFrame:
    """How many words of each document the mix takes.

    Columns ``key, size, source, source_size, target, taken`` and ``block_words``,
    the words of a block. ``taken`` is at most ``repeats`` times ``size``. A
    source misses its target by the few slots by which the schedule may miss a
    share, each 1/``slots`` of the mix.
    """
    raw = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        shuffle_hash(F.col(key)).alias("_hash"),
    )
    sized = materialise(raw, "mix_sizes")
    sources = materialise(targets(sized, weights, share, repeats), "mix_targets")
    total = F.sum("target").over(Window.partitionBy())
    # Blocks of a source divide its words evenly, each as near to a slot's words as that allows.
    blocks = F.ceil(F.col("source_size") * F.lit(float(slots)) / total).cast("long")
    blocked = sources.withColumn("_blocks", F.when(F.col("target") > 0, blocks))
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    placed = positions(
        sized.alias("l").join(blocked.alias("r"), same).select("l.*", *[
            F.col(f"r.{c}") for c in ("source_no", "source_size", "target", "_blocks")
        ])
    )
    # Slots beyond the last repeat are left unused.
    taken_blocks = (
        schedule(sources, slots)
        .join(blocked.select("source_no", "_blocks"), "source_no")
        .where(F.col("rank") < F.col("_blocks") * repeats)
        .groupBy("source_no", (F.col("rank") % F.col("_blocks")).alias("block"))
        .agg(F.count("*").alias("times"))
    )
    placed = materialise(placed, "mix_positions")
    begin, end = F.col("position"), F.col("position") + F.col("size")
    first = F.expr("cast(floor(cast(position as decimal(38,0)) * _blocks / source_size) as bigint)")
    last = F.expr(
        "cast(floor(cast(position + size as decimal(38,0)) * _blocks / source_size) as bigint)"
    )
    pieces = placed.where((F.col("size") > 0) & F.col("_blocks").isNotNull()).select(
        "source_no", "source_size", "position", "size", "_blocks",
        F.explode(F.sequence(F.greatest(first - 1, F.lit(0)), last + 1)).alias("block"),
    )
    low = F.expr("cast(floor(cast(block as decimal(38,0)) * source_size / _blocks) as bigint)")
    high = F.expr("cast(floor(cast(block + 1 as decimal(38,0)) * source_size / _blocks) as bigint)")
    overlap = F.least(end, F.col("_high")) - F.greatest(begin, F.col("_low"))
    taken = (
        pieces.withColumn("_low", low).withColumn("_high", high)
        .withColumn("_overlap", overlap)
        .where(F.col("_overlap") > 0)
        .join(taken_blocks, ["source_no", "block"])
        .groupBy("source_no", "position")
        .agg(F.sum(F.col("_overlap") * F.col("times")).alias("_taken"))
    )
    counted = F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(0)
    return placed.join(taken, ["source_no", "position"], "left").select(
        F.col("_key").alias(key), "size", "source", "source_size", "target",
        counted.cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, the rest of it cut to its words.

    Columns are those of ``docs``. A document taken once and a half gives itself
    and its first half. Rows with equal keys share what is taken of them evenly
    in the order of their sizes, which is that of the mix.
    """
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    took = mix(docs, **options)
    order = Window.partitionBy("_k", "_size").orderBy("_s")
    taken = took.select(
        F.col(key).alias("_k"), F.col("size").alias("_size"), F.col("taken").alias("_taken"),
        F.col("source").alias("_s"),
    ).withColumn("_n", F.row_number().over(order))
    columns = [F.col(c) for c in docs.columns]
    numbered = docs.select(
        *columns, F.col(key).alias("_k"), word_count(F.col(text)).alias("_size"),
        F.col(options.get("source", "source")).alias("_s"),
    ).withColumn("_n", F.row_number().over(order)).drop("_s")
    same = (
        F.col("l._k").eqNullSafe(F.col("r._k"))
        & (F.col("l._size") == F.col("r._size")) & (F.col("l._n") == F.col("r._n"))
    )
    both = numbered.alias("l").join(taken.alias("r"), same).where(F.col("r._taken") > 0)
    copies = F.sequence(F.lit(0), F.expr("cast((r._taken - 1) div r._size as int)"))
    spread = both.select("l.*", F.col("r._taken").alias("_taken"), F.explode(copies).alias("_copy"))
    words_left = F.col("_taken") - F.col("_copy") * F.col("_size")
    # Each piece is white space and the word behind it.
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), words_left.cast("int")), "")
    kept = F.when(words_left >= F.col("_size"), F.col(text)).otherwise(cut)
    return spread.select(*[kept.alias(c) if c == text else F.col(c) for c in docs.columns])
