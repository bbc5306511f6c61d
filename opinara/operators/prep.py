"""Projections and filters on comment tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import is_target, label_value

# The marks of a quoted reply and of sarcasm, and the names of
# the 50 states and the federal district as they stand in user flair.
QUOTE_MARK = "&gt;"
SARCASM_MARK = "/s"
STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "District of Columbia", "Florida", "Georgia",
    "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
    "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
    "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin",
    "Wyoming",
)

# The columns taken from each input and the names they get.
COMMENT_COLUMNS = {
    "id": "id",
    "body": "body",
    "link_id": "link_id",
    "created_utc": "created_utc",
    "author_flair_text": "author_flair_text",
    "score": "com_score",
}
SUBMISSION_COLUMNS = {"id": "sub_id", "title": "title", "score": "sub_score"}
LABEL_COLUMNS = {
    "Input_id": "iid",
    "labeldem": "Democrat",
    "labelgop": "Republican",
    "labeldjt": "Trump",
}


def slim(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, in the mapping's order."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def one_vs_rest(
    df: DataFrame, label: str = "label", targets: Mapping[str, int] | None = None
) -> DataFrame:
    """Cast the label text and add a 0/1 column for each target value."""
    wanted = {"poslabel": 1, "neglabel": -1} if targets is None else targets
    cast = df.withColumn(label, label_value(F.col(label)))
    return cast.withColumns({name: is_target(F.col(label), v) for name, v in wanted.items()})


def is_unmarked(
    body: Column, quote: str = QUOTE_MARK, sarcasm: str = SARCASM_MARK, mode: str = "substring"
) -> Column:
    """True for text without the quote mark and the sarcasm mark; NULL for NULL.

    ``substring`` also drops text where the sarcasm mark is part of a longer
    word, as in a URL; ``token`` drops it only where it stands alone.
    """
    if mode == "substring":
        sarcastic = F.contains(body, F.lit(sarcasm))
    elif mode == "token":
        spaced = F.concat(F.lit(" "), F.regexp_replace(body, r"\s", " "), F.lit(" "))
        sarcastic = F.contains(spaced, F.lit(f" {sarcasm} "))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return ~F.contains(body, F.lit(quote)) & ~sarcastic


def drop_marked(
    df: DataFrame,
    body: str = "body",
    quote: str = QUOTE_MARK,
    sarcasm: str = SARCASM_MARK,
    mode: str = "substring",
) -> DataFrame:
    """Drop quoted replies, sarcastic comments and comments without a text."""
    return df.where(is_unmarked(F.col(body), quote, sarcasm, mode))


def with_flag(df: DataFrame, col: str, value: Any = 1) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def exclude_keys(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    """Drop the rows whose key is listed; rows without a key stay."""
    kept = df
    for value in values:
        kept = kept.where(~F.col(col).eqNullSafe(F.lit(value)))  # lit keeps a Column as it is
    return kept


def in_list(df: DataFrame, col: str, values: Sequence[Any] = STATES) -> DataFrame:
    return df.where(F.col(col).isin(*values))
