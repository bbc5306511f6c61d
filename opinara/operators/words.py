"""The text stage on whole tables: normalise each text once, derive the rest."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as T

PARTS = ("normalised", "unigrams", "bigrams", "trigrams", "word_tokens", "combined", "words")


def counted_once(df: DataFrame, stage: str) -> DataFrame:
    """The same rows, counted on the way as ``n_rows`` under a name that begins with ``stage``.

    Catalyst prunes columns through the count but moves no filter below it, so
    what lies below runs once for each row, whatever the caller filters on.
    Filters that should reach the scan belong before it.
    """
    return df.observe(f"{stage}-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n_rows"))


def with_text(df: DataFrame, body: str = "body", parts: Sequence[str] = ("words",)) -> DataFrame:
    """Add the asked-for text columns, named as in ``PARTS``; the rest stays.

    Each stage is a projection of its own, and a column that several later ones
    read is not merged into them, so the normaliser runs once for each text.
    Later filters stay above the text stage.
    """
    unknown = set(parts) - set(PARTS)
    if unknown:
        raise ValueError(f"unknown text parts: {sorted(unknown)}")
    kept = [F.col(c) for c in df.columns]
    normalised, segment_words = F.col("_norm"), F.col("_segment_words")
    pairs, bigrams, trigrams = F.col("_pairs"), F.col("_bigrams"), F.col("_trigrams")
    triples = T.extend_grams(pairs, segment_words, 3)
    staged = (
        df.withColumn("_norm", T.normalise(F.col(body)))
        .withColumn("_segment_words", T.segment_words_of(normalised))
        .withColumn("_pairs", T.extend_grams(segment_words, segment_words, 2))
        .withColumn("_bigrams", F.array_compact(pairs))
        .withColumn("_trigrams", F.array_compact(triples))
    )
    unigrams = T.unigrams_of(normalised)
    derived: dict[str, Column] = {
        "normalised": normalised,
        "word_tokens": T.word_tokens_of(normalised),
        "unigrams": unigrams,
        "bigrams": bigrams,
        "trigrams": trigrams,
        "combined": T.combine(unigrams, bigrams, trigrams),
        "words": T.combine_words(unigrams, bigrams, trigrams),
    }
    return counted_once(
        staged.select(*kept, *[derived[part].alias(part) for part in parts]), "text"
    )


def with_words(df: DataFrame, body: str = "body", drop_empty: bool = False) -> DataFrame:
    """Replace the text column by ``words``, the array the models read."""
    worded = with_text(df, body, ("words",)).drop(body)
    if drop_empty:
        worded = worded.withColumn("words", F.array_remove("words", ""))
    return worded
