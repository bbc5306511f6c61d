from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from opinara.operators import features
from opinara.operators.words import with_words


@pytest.fixture(scope="module")
def worded(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return with_words(documents.select("doc_id", F.col("text").alias("body"))).cache()


@pytest.fixture(scope="module")
def counted(worded):
    documents, total = Counter(), Counter()
    for row in worded.collect():
        documents.update(set(row.words))
        total.update(row.words)
    return documents, total


def test_document_frequency(worded, counted):
    found = {r.term: r.doc_freq for r in features.document_frequency(worded).collect()}
    assert found == {term: n for term, n in counted[0].items() if n >= 5}


@pytest.mark.parametrize("slots", [1, 50, 5000, 1 << 20])
def test_pruned_document_frequency(worded, counted, slots):
    """The rows of plain counting, however crowded the sketch, which never counts too few."""
    sketch = features.count_sketch(worded, slots=slots).cache()
    found = {r.term: r.doc_freq for r in features.document_frequency(worded, sketch=sketch, slots=slots).collect()}
    assert found == {term: n for term, n in counted[0].items() if n >= 5}
    assert sketch.count() <= 2 * slots


def test_sketches_add_up_and_spare_the_shuffle(spark, worded, counted):
    many = worded.select("words").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    many = many.select(
        F.when(F.col("copy") == 1, F.col("words")).otherwise(
            F.transform("words", lambda w: F.when(F.xxhash64(w) % 2 == 0, w).otherwise(F.concat(w, "copy")))
        ).alias("words")
    ).cache()
    plain = {r.term: r.doc_freq for r in features.document_frequency(many).collect()}
    sketch = features.count_sketch(many).cache()
    assert plain == {r.term: r.doc_freq for r in features.document_frequency(many, sketch=sketch).collect()}
    halves = many.withColumn("half", F.xxhash64("words") % 2 == 0)
    parts = [features.count_sketch(halves.where(h)) for h in ("half", "not half")]
    added = parts[0].unionByName(parts[1]).groupBy("slot").agg(F.sum("n").alias("n"))
    assert added.exceptAll(sketch).isEmpty() and sketch.exceptAll(added).isEmpty()
    terms = many.select(F.explode("words").alias("term")).distinct()
    assert features.prunable(terms, sketch, 5.0).count() < 0.5 * terms.count()


def test_pruned_document_frequency_of_nothing(spark):
    rows = [(None,), ([],), ([None, "a"],)] + [(["", "a", "a"],)] * 4
    words = spark.createDataFrame(rows, "words array<string>")
    for held in (words, words.limit(0)):
        found = features.document_frequency(held, min_df=4, sketch=features.count_sketch(held))
        assert sorted(found.collect()) == sorted(features.document_frequency(held, min_df=4).collect())


@pytest.mark.parametrize("size", [1, 10, 700, 1 << 18])
def test_vocabulary(worded, counted, size):
    documents, total = counted
    frequent = [term for term, n in documents.items() if n >= 5]
    best = sorted(frequent, key=lambda t: (-total[t], t.encode()))[:size]
    found = features.vocabulary(worded, size=size, eligible="n_eligible").collect()
    assert {r.n_eligible for r in found} == {len(frequent)}
    assert {r.term: (r.doc_freq, r.term_count) for r in found} == {
        t: (documents[t], total[t]) for t in best
    }


def test_vectoriser_has_the_terms_of_the_stock_one(worded):
    ours = features.fit_vocabulary(worded)
    stock = CountVectorizer(inputCol="words", outputCol="f", binary=True, minDF=5.0).fit(worded)
    assert set(ours.vocabulary) == set(stock.vocabulary)
    again = features.fit_vocabulary(worded.repartition(7), size=300)
    assert set(again.vocabulary) == set(features.fit_vocabulary(worded, size=300).vocabulary)
    assert len(again.vocabulary) == 300
    assert ours.getBinary()


def test_empty_token_is_a_term(spark):
    df = with_words(spark.createDataFrame([("Hello",)] * 5, "body string"))
    assert {r.term for r in features.document_frequency(df).collect()} == {"hello", ""}
    assert set(features.fit_vocabulary(df).vocabulary) == {"", "hello"}
    with pytest.raises(ValueError):
        features.fit_vocabulary(df, min_df=6)


def test_missing_words_count_for_nothing(spark):
    df = spark.createDataFrame([(["a", "a"],), (None,), (["a"],)], "words array<string>")
    assert [tuple(r) for r in features.document_frequency(df, min_df=1).collect()] == [("a", 2)]
    assert [tuple(r) for r in features.vocabulary(df, min_df=1).collect()] == [("a", 2, 3)]


def test_presence_agrees_with_the_vectors(worded):
    vectoriser = features.fit_vocabulary(worded, size=500)
    terms = vectoriser.vocabulary
    wanted = {
        (row.doc_id, terms[i])
        for row in vectoriser.transform(worded).collect()
        for i in row.features.indices
    }
    vocab = features.vocabulary(worded, size=500)
    found = features.presence(worded, vocab, id="doc_id").collect()
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted
