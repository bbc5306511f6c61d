"""The SQL surface: temporary views and SQL functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from opinara.functions import text as T

DAILY_RATES = """
    SELECT sum(pos) / count(pos) AS pos_percent,
           sum(neg) / count(neg) AS neg_percent,
           date_from_unix_date(CAST(floor(created_utc / 86400) AS INT)) AS date
    FROM scored
    GROUP BY date
    ORDER BY date
"""

STATE_RATES = """
    SELECT author_flair_text AS state, sum(pos) / count(pos) AS pos_percent,
           sum(neg) / count(neg) AS neg_percent
    FROM scored
    WHERE author_flair_text IN (SELECT state FROM states)
    GROUP BY author_flair_text
    ORDER BY pos_percent DESC, state
"""

# Over a view of flags tallied by submission, as ``linked_tally`` makes it.
TITLE_RATES = """
    SELECT title, sub_score, sum(negative_sum) / sum(negative_count) AS neg_percent
    FROM tallied
    WHERE title LIKE :pattern
    GROUP BY sub_score, title
    ORDER BY neg_percent DESC, title, sub_score
    LIMIT :n
"""


def score_rates(column: str) -> str:
    """Both rates for each value of a score column of ``scored``."""
    return f"""
        SELECT {column}, sum(pos) / count(pos) AS pos_percent,
               sum(neg) / count(neg) AS neg_percent
        FROM scored
        GROUP BY {column}
        ORDER BY {column}
    """


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _replace(text: str, pattern: str, by: str) -> str:
    return f'regexp_replace({text}, r"{pattern}", "{by}")'


def register_functions(spark: SparkSession) -> None:
    """Define ``normalise``, ``unigrams``, ``bigrams``, ``trigrams``, ``comment_words``.

    They are SQL functions, which Spark inlines into the query, and follow the
    column functions of ``functions.text`` step by step. What a step reads more
    than once is the parameter of a function of its own, so it is computed once.
    """
    array = "ARRAY<STRING>"
    spaces = "".join(f"\\u{ord(c):04x}" for c in T.UNICODE_SPACES)
    text = _replace("body", T.REPEATED_MARK, " $1 ")
    text = _replace(text, T.BREAK_OR_URL, " ")
    text = f'trim(BOTH "{spaces}" FROM {text})'
    text = _replace(text, T.DETACHED_MARK, " $1 ")
    text = f'lower(trim({_replace(text, T.STRAY_SYMBOLS, " ")}))'
    unigrams = _replace(_replace("normalised", " [.!?,;:] ", " "), r" [.!?,;:]\z", "")
    marks = ", ".join(f'"{mark}"' for mark in T.MARKS)
    segments = (
        f'transform(split(normalised, r"{T.SPACES}"), '
        f"word -> CASE WHEN word NOT IN ({marks}) THEN word END)"
    )

    def extend(grams: str, position: int) -> str:
        following = f"slice(segments, {position}, {T.TO_THE_END})"
        return f'zip_with({grams}, {following}, (gram, word) -> gram || "_" || word)'

    pairs = extend("segments", 2)
    triples = extend(pairs, 3)
    words = (
        'split(unigrams_of(normalised) || " " || '
        'array_join(bigrams_of(segments), " ") || " " || '
        'array_join(trigrams_of(segments), " "), " ")'
    )
    both = f"normalised STRING, segments {array}"
    functions = [
        ("normalise", "body STRING", "STRING", text),
        ("unigrams_of", "normalised STRING", "STRING", unigrams),
        ("segments_of", "normalised STRING", array, segments),
        ("bigrams_of", f"segments {array}", array, f"array_compact({pairs})"),
        ("trigrams_of", f"segments {array}", array, f"array_compact({triples})"),
        ("words_from", both, array, words),
        ("words_of", "normalised STRING", array, "words_from(normalised, segments_of(normalised))"),
        ("unigrams", "body STRING", "STRING", "unigrams_of(normalise(body))"),
        ("bigrams", "body STRING", array, "bigrams_of(segments_of(normalise(body)))"),
        ("trigrams", "body STRING", array, "trigrams_of(segments_of(normalise(body)))"),
        ("comment_words", "body STRING", array, "words_of(normalise(body))"),
    ]
    for name, parameter, kind, expression in functions:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter}) "
            f"RETURNS {kind} RETURN {expression}"
        )
