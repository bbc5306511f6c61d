import random

import by_hand
import pytest
from pyspark.sql import functions as F

from opinara.functions import combined, ngrams, normalise, tokens, unigrams, word_tokens
from opinara.operators.words import PARTS, with_text, with_words
from opinara.plans.sql import register_functions

# Text, normalised, unigrams, bigrams, trigrams.
EDGES = [
    ("Hello", "hello", "hello", "", ""),
    ("", "", "", "", ""),
    (
        "I like it. You do",
        "i like it . you do",
        "i like it you do",
        "i_like like_it you_do",
        "i_like_it",
    ),
    ("wait...what", "wait . what", "wait what", "", ""),
    ("what?!", "what? !", "what?", "", ""),
    ("a-b a--b", "a-b a b", "a-b a b", "a-b_a a_b", "a-b_a_b"),
    ("f(x)", "f x", "f x", "f_x", ""),
    ("$5 $x 5% x%", "$5 x 5% x", "$5 x 5% x", "$5_x x_5% 5%_x", "$5_x_5% x_5%_x"),
    ("see (https://x.co/a) now", "see now", "see now", "see_now", ""),
    ("a . , b", "a . , b", "a , b", "", ""),
    ("a b c", "a b c", "a b c", "a_b b_c", "a_b_c"),
    ("a(b", "a b", "a b", "a_b", ""),
    ("..........", ".", ".", "", ""),
    ("hi. ", "hi .", "hi", "", ""),
    ("$$5 5%%", "$5 5%", "$5 5%", "$5_5%", ""),
    ("line\r\nbreak\ttab", "line break tab", "line break tab", "line_break break_tab",
     "line_break_tab"),
    ("wwwhttp://a b", "www b", "www b", "www_b", ""),
]

PIECES = (
    list("abÉñ𝐀𐐀é09٣𝟎²_.,:!?;'$%-()\"/<>&\t\n😀́  \u0085\x1c ")
    + ["http://", "https://x.co", "www.", " . ", "  ", "..", " a ", " bc ", "$5", "5%", "(www."]
)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, body string")


def collected(df):
    return [row for row in df.orderBy("id").collect()]


def test_edges(spark):
    df = with_text(frame(spark, [edge[0] for edge in EDGES]), "body", PARTS)
    for (text, norm, uni, bi, tri), row in zip(EDGES, collected(df), strict=True):
        assert row.normalised == norm, text
        assert row.unigrams == uni, text
        assert " ".join(row.bigrams) == bi, text
        assert " ".join(row.trigrams) == tri, text
        assert row.combined == f"{uni} {bi} {tri}", text
        assert row.words == row.combined.split(" "), text


def test_random_texts_against_the_rules_by_hand(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(20_000)]
    df = with_text(frame(spark, texts).repartition(8), "body", PARTS)
    for text, row in zip(texts, collected(df), strict=True):
        norm = by_hand.normalise(text)
        assert row.normalised == norm, repr(text)
        assert row.unigrams == by_hand.unigrams(norm), repr(text)
        assert row.word_tokens == norm.split(), repr(text)
        assert row.bigrams == by_hand.ngrams(norm, 2), repr(text)
        assert row.trigrams == by_hand.ngrams(norm, 3), repr(text)
        assert row.words == by_hand.words(text), repr(text)


def test_real_texts_against_the_rules_by_hand(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = documents.select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    for row in collected(with_text(df, "body", ["words"])):
        assert row.words == by_hand.words(row.body)


def test_columns_agree_with_table_form(spark):
    body = F.col("body")
    df = with_text(frame(spark, [edge[0] for edge in EDGES]), "body", PARTS)
    checks = {
        "normalised": normalise(body),
        "unigrams": unigrams(body),
        "bigrams": ngrams(body, 2),
        "trigrams": ngrams(body, 3),
        "word_tokens": word_tokens(body),
        "combined": combined(body),
        "words": tokens(body),
    }
    for name, column in checks.items():
        assert df.where(~column.eqNullSafe(F.col(name))).count() == 0, name


def test_sql_functions_agree_with_columns(spark):
    register_functions(spark)
    df = with_text(frame(spark, [edge[0] for edge in EDGES] + [None]), "body", PARTS)
    df.createOrReplaceTempView("edges")
    differing = spark.sql(
        """SELECT * FROM edges WHERE NOT (normalise(body) <=> normalised)
           OR NOT (unigrams(body) <=> unigrams) OR NOT (bigrams(body) <=> bigrams)
           OR NOT (trigrams(body) <=> trigrams) OR NOT (comment_words(body) <=> words)"""
    )
    assert differing.count() == 0


def test_null_stays_null(spark):
    row = with_text(frame(spark, [None]), "body", PARTS).first()
    assert all(row[part] is None for part in PARTS)


def test_empty_tokens_stay_unless_dropped(spark):
    df = frame(spark, ["Hello", ""])
    assert [r.words for r in collected(with_words(df))] == [["hello", "", ""], ["", "", ""]]
    assert [r.words for r in collected(with_words(df, drop_empty=True))] == [["hello"], []]


def test_ngram_count(spark):
    """A text without lone marks has one n-gram less than words for each step of n."""
    df = frame(spark, ["a b c d e f"]).select(
        *[F.array_size(ngrams(F.col("body"), n)).alias(f"n{n}") for n in (2, 3, 4, 7)]
    )
    assert df.first() == (5, 4, 3, 0)
    with pytest.raises(ValueError):
        ngrams(F.col("body"), 1)


def test_long_runs(spark):
    text = "x" + "-" * 300_000 + " . " * 100_000 + "." * 300_000 + "y" * 300_000 + " z"
    row = with_text(frame(spark, [text]), "body", ["normalised", "bigrams"]).first()
    assert row.bigrams == ["y" * 300_000 + "_z"]
    assert row.normalised == by_hand.normalise(text)


def test_unknown_part(spark):
    with pytest.raises(ValueError):
        with_text(frame(spark, ["a"]), "body", ["fourgrams"])
