"""Toxicity by nearest examples: exact neighbours, held-out accuracy, edge rows."""

import zlib

import numpy as np
import pytest

from opinara.llm import toxicity
from opinara.llm.toxicity import BlockMaxIndex, Vectors

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, toxic string, terms int, held_out int, vote string"


def vectors(rng, n, terms, most):
    first, ids, weights = [0], [], []
    for _ in range(n):
        own = np.sort(rng.choice(terms, rng.integers(0, most), replace=False))
        w = rng.integers(1, 4, len(own)).astype(float)
        ids.append(own)
        weights.append(w / np.sqrt((w**2).sum()) if len(own) else w)
        first.append(first[-1] + len(own))
    return Vectors(np.array(first), np.concatenate(ids).astype(np.int64), np.concatenate(weights))


def dense(rows, terms):
    made = np.zeros((len(rows.first) - 1, terms))
    made[rows.owner, rows.terms] = rows.weights
    return made


@pytest.mark.parametrize("leave_out", [False, True])
def test_nearest_are_those_of_all_pairs(leave_out):
    rng = np.random.default_rng(3)
    examples, texts = vectors(rng, 700, 50, 6), vectors(rng, 300, 50, 9)
    if leave_out:
        texts = examples
    own = np.arange(700) if leave_out else None
    names, cosines = BlockMaxIndex(examples, 50).nearest(texts, 10, own)
    every = np.round(dense(texts, 50) @ dense(examples, 50).T, 12)
    if leave_out:
        np.fill_diagonal(every, 0.0)
    for i, row in enumerate(every):
        order = np.lexsort((np.arange(700), -row))[:10]
        there = row[order] > 0
        assert np.allclose(cosines[i], np.where(there, row[order], 0.0), atol=1e-11)
        assert list(names[i]) == list(np.where(there, order, 700))


def test_blocks_beyond_reach_are_not_read():
    rng = np.random.default_rng(4)
    examples = vectors(rng, 4000, 200, 4)
    index, read = BlockMaxIndex(examples, 200), []
    cosines = index.cosines
    index.cosines = lambda texts, rows, blocks: read.append(len(rows)) or cosines(texts, rows, blocks)
    index.nearest(vectors(rng, 200, 200, 4), 5)
    assert sum(read) < 0.5 * 200 * index.n_blocks


def test_shares_never_fall_and_keep_the_whole():
    vote = np.array([0.0, 0.0, 0.1, 0.2, 0.3, 0.9, 0.95])
    toxic = np.array([0, 0, 1, 0, 0, 1, 1])
    shares = toxicity.monotone_shares(vote, toxic, np.ones(7))
    assert (np.diff(shares) >= 0).all() and shares[0] < 0.5 < shares[-1]


def test_held_out_rows_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = toxicity.score_texts(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    for row in judged:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert row.predicted == (row.score >= 0.5) and 0 <= row.score <= 1
        assert all(0 < e.cosine <= 1 + 1e-9 for e in row.evidence)
    held = [r for r in judged if r.held_out]
    caught = [r.predicted for r in held if r.toxic == 1]
    left = [1 - r.predicted for r in held if r.toxic == 0]
    assert np.mean(caught) > 0.8 and np.mean(left) > 0.99
    # Probabilities are near the share of toxic rows.
    assert abs(np.mean([r.score for r in held]) - np.mean([r.toxic for r in held])) < 0.02


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = labels.where(~toxicity.held_out())
    first = {r.doc_id: r.score for r in toxicity.score_texts(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in toxicity.score_texts(docs, kept).collect()}


def test_edges(spark):
    bad, good = "you utter fool and clown number", "a quiet walk along the river number"
    rows = [(i, f"{bad if i % 3 == 0 else good} {i}") for i in range(400)]
    edge = [(1000, None), (1001, ""), (1002, " \n"), (1003, "fool clown " * 30_000), (None, bad), (3, bad), (3, bad)]
    docs = spark.createDataFrame([(*r, "clash", 1, 1, "x") for r in rows + edge], SCHEMA)
    marks = [(i, int(i % 3 == 0), "x") for i in range(400)] + [(5, None, "x"), (6, 1, "x"), (None, 1, "x"), (9999, 1, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    found = toxicity.score_texts(docs, labels).collect()
    assert len(found) == len(rows) + len(edge)
    by_key = {}
    for r in found:
        by_key.setdefault(r.doc_id, []).append(r.predicted)
    assert by_key[1003] == [1] and by_key[None] == [1] and by_key[3] == [1, 1, 1]
    assert by_key[1000] == by_key[1001] == by_key[1002]
    assert all(by_key[i] == [int(i % 3 == 0)] for i in range(400) if i != 3)


def test_empty_tables_and_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_texts(docs.limit(0), labels).collect() == []
    assert [r.score for r in toxicity.score_texts(docs, labels).collect()] == [0.0, 0.0]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in toxicity.score_texts(docs, ones).collect()} == {1.0}
