"""Report tables: positive and negative rates side by side, and map shades."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import intensity
from opinara.operators.evaluate import roc
from opinara.operators.prep import exclude_keys
from opinara.operators.rates import rates

BOTH = {"positive": "pos", "negative": "neg"}

# The bounds of the colour scales, and the places no map shows.
SHADE_BOUNDS = {"positive": (0.24, 0.28), "negative": (0.90, 0.95), "diff": (0.63, 0.69)}
OFF_THE_MAP = ("District of Columbia", "Puerto Rico")


def rate_report(
    df: DataFrame,
    key: str,
    measures: Mapping[str, str] | None = None,
    exclude: Sequence[Any] = (),
    key_column: Column | None = None,
) -> DataFrame:
    """Both rates by key out of one aggregation.

    Joining two separately grouped tables on the key gives the same rows: every
    scored comment has both flags, so no key is in only one of them.
    """
    keyed = F.col(key) if key_column is None else key_column.alias(key)
    return exclude_keys(rates(df, [keyed], measures or BOTH), key, exclude)


def shading(
    df: DataFrame,
    measure: str,
    lo: float,
    hi: float,
    skip: Sequence[str] = OFF_THE_MAP,
    key: str = "state",
) -> DataFrame:
    """The shade of each place for one measure of a report."""
    shown = exclude_keys(df, key, skip)
    return shown.select(key, intensity(F.col(measure), lo, hi).alias(f"{measure}_shade"))


def shade_report(
    df: DataFrame,
    scales: Mapping[str, tuple[float, float]] | None = None,
    skip: Sequence[str] = OFF_THE_MAP,
    key: str = "state",
) -> DataFrame:
    """The shades of all measures as rows: place, measure, shade."""
    shown = exclude_keys(df, key, skip)
    shades = [
        F.struct(F.lit(measure).alias("measure"), intensity(F.col(measure), lo, hi).alias("shade"))
        for measure, (lo, hi) in (scales or SHADE_BOUNDS).items()
    ]
    return shown.select(key, F.inline(F.array(*shades)))


def roc_report(scored: Mapping[str, DataFrame]) -> DataFrame:
    """The curves of several models, each given as a table of score and label."""
    curves = [
        roc(pairs, "score", "label").select(F.lit(name).alias("model"), "*")
        for name, pairs in scored.items()
    ]
    return reduce(DataFrame.unionByName, curves)
