"""Binary bag-of-words features."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.operators.ranges import in_ranges, with_sums_before
from opinara.session import materialise

# The least number of texts a term is in, and the number of terms kept.
MIN_DOCUMENTS = 5.0
VOCABULARY_SIZE = 1 << 18

# Slots of a sketch of document counts in each of its rows, and the seeds of the rows.
SKETCH_SLOTS = 1 << 20
SKETCH_SEEDS = (17, 4711)


def _slot(term: str, row: int, slots: int) -> Column:
    """The slot of a term in a row of the sketch; rows do not overlap."""
    hashed = F.xxhash64(F.lit(SKETCH_SEEDS[row]), F.col(term))
    return (F.pmod(hashed, F.lit(slots)) + row * slots).cast("int")


def count_sketch(df: DataFrame, words: str = "words", slots: int = SKETCH_SLOTS) -> DataFrame:
    """``slot, n``: upper bounds of how many texts hold a term, whatever the number of terms.

    Each text adds one to a slot in every row of the sketch for each of its terms, so
    no slot of a term holds less than the term's texts. Sketches of parts of a table add
    up by slot; a task sends at most one row for each slot, and no term.
    """
    terms = df.select(F.explode_outer(F.array_distinct(words)).alias("term")).where("term is not null")
    own = F.array(*[_slot("term", row, slots) for row in range(len(SKETCH_SEEDS))])
    return terms.select(F.explode_outer(own).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))


def prunable(terms: DataFrame, sketch: DataFrame, min_df: float, slots: int = SKETCH_SLOTS) -> DataFrame:
    """The rows of ``terms`` whose upper bound reaches ``min_df``; no such term is left out.

    The slots that reach it, two for each of ``slots`` at most, are sent to the tasks.
    """
    reached = sketch.where(F.col("n") >= F.lit(min_df)).select("slot")
    for row in range(len(SKETCH_SEEDS)):
        own = reached.where(F.col("slot").between(row * slots, (row + 1) * slots - 1))
        terms = terms.withColumn("_slot", _slot("term", row, slots))
        terms = terms.join(F.broadcast(own), F.col("_slot") == F.col("slot"), "left_semi").drop("_slot")
    return terms


def document_frequency(
    df: DataFrame, words: str = "words", min_df: float = MIN_DOCUMENTS, sketch: DataFrame | None = None,
    slots: int = SKETCH_SLOTS,
) -> DataFrame:
    """How many texts hold each term, for terms in at least ``min_df`` texts.

    Each text gives a term once, so the count before the shuffle leaves a task
    with one row for each term it met, however common the term.

    With a ``sketch`` of the same texts (``count_sketch``, of as many ``slots``), terms
    that cannot reach ``min_df`` do not enter the shuffle. The rows are the same. The
    sketch reads the words once more, so it pays for words that are written, and where
    most terms are rare.

    ``explode_outer`` because for ``explode`` Spark infers a filter on the array
    and pushes it below the text stage, which then runs again for the filter.
    """
    terms = df.select(F.explode_outer(F.array_distinct(words)).alias("term"))
    if sketch is not None:
        terms = prunable(terms, sketch, min_df, slots)
    counted = terms.groupBy("term").agg(F.count("*").alias("doc_freq"))
    return counted.where(F.col("term").isNotNull() & (F.col("doc_freq") >= F.lit(min_df)))


def _term_counts(df: DataFrame, words: str) -> DataFrame:
    """Each term's number of texts and of occurrences, in one aggregation.

    In the sorted words of a text an occurrence that differs from the one
    before it is the first of its term.
    """
    nothing = F.array(F.lit(None).cast("string"))
    ordered = df.select(F.sort_array(words).alias("_words"))
    marked = F.zip_with(
        F.col("_words"),
        F.concat(nothing, F.col("_words")),
        lambda word, before: F.struct(
            word.alias("term"), (~word.eqNullSafe(before)).cast("int").alias("first")
        ),
    )
    # The lambda in a projection of its own leaves the explode to generated code.
    words_with_mark = ordered.select(marked.alias("_marked")).select(F.inline_outer("_marked"))
    return (
        words_with_mark.groupBy("term")
        .agg(F.sum("first").alias("doc_freq"), F.count("*").alias("term_count"))
        .where(F.col("term").isNotNull())
    )


def vocabulary(
    df: DataFrame,
    words: str = "words",
    min_df: float = MIN_DOCUMENTS,
    size: int = VOCABULARY_SIZE,
    eligible: str | None = None,
) -> DataFrame:
    """The ``size`` most frequent terms among those in at least ``min_df`` texts.

    Equal counts go by term, so the choice does not depend on the partitioning.
    The text is read once: the counts are written to the shared folder. Only if there
    are more than ``size`` are they cut into ranges of rank, of which those that ``size``
    reaches are ranked, each by itself. The result is written too, so that its size is
    known to a join.
    ``eligible`` names a column for the number of terms there were to choose from.
    """
    frequent = _term_counts(df, words).where(F.col("doc_freq") >= F.lit(min_df))
    written = materialise(frequent, "terms")
    n_terms = written.count()
    if n_terms <= size:
        total = [F.lit(n_terms).cast("long").alias(eligible)] if eligible else []
        return written.select("term", "doc_freq", "term_count", *total)
    order = [F.desc("term_count"), F.asc("term")]
    placed = in_ranges(written, order, "term_ranges")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    reached = with_sums_before(placed, {"terms": F.count("*")}).where(F.col("terms_before") < size)
    kept = reached.withColumn("_rank", F.col("terms_before") + inside).where(F.col("_rank") <= size)
    counted = [F.col("terms_total").alias(eligible)] if eligible else []
    return materialise(kept.select("term", "doc_freq", "term_count", *counted), "vocabulary")


def fit_vocabulary(
    df: DataFrame,
    words: str = "words",
    min_df: float = MIN_DOCUMENTS,
    size: int = VOCABULARY_SIZE,
    features: str = "features",
) -> CountVectorizerModel:
    """A vectoriser that marks which vocabulary terms a text holds.

    Fitted to the vocabulary itself, one term a row, so its own choice of terms
    takes all of them, and ``size`` terms at most come to the driver.
    """
    kept = vocabulary(df, words, min_df, size).select(F.array("term").alias(words))
    if kept.isEmpty():
        raise ValueError(f"no term is in {min_df:g} texts")
    vectoriser = CountVectorizer(
        inputCol=words, outputCol=features, binary=True, minDF=1.0, vocabSize=size
    )
    return vectoriser.fit(kept)


def presence(df: DataFrame, vocab: DataFrame, id: str = "id", words: str = "words") -> DataFrame:
    """The features in long form: one row for each text and vocabulary term in it.

    ``vocab`` has a column ``term``. A vocabulary cut off by ``vocabulary`` is
    small enough for Spark to broadcast; a larger table is joined by a shuffle.
    """
    terms = df.select(id, F.explode_outer(F.array_distinct(words)).alias("term"))
    return terms.join(vocab.select("term"), "term", "left_semi").select(id, "term")
