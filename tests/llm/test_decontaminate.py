import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import decontaminate as D

SF_DIR = "/root/testdata/sf0.001"


def spoken(text):
    return [D._bare(w) for w in (text or "").encode().lower().split()]


def item_parts(text):
    """An item's words and its answer's, read sentence by sentence."""
    sentences, own = [], []
    for word in (text or "").encode().lower().split():
        own.append(D._bare(word))
        if word[-1:] in b".!?":
            sentences.append(own)
            own = []
    sentences += [own] if own else []
    words = [w for s in sentences for w in s]
    return words, sentences[-1] if len(sentences) > 1 else []


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row
        row = [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


def holds(item, words):
    whole, answer = item
    share = subsequence(whole, words) / len(whole)
    if share >= D.COPIED:
        return True
    return share >= D.PARAPHRASED and bool(answer) and subsequence(answer, words) >= D.ANSWERED * len(answer)


def could(item, words, share):
    have, want = Counter(words), Counter(item[0])
    return sum(min(n, have[w]) for w, n in want.items()) >= share * len(item[0])


@pytest.fixture(scope="module")
def tables(spark):
    """The documents, and texts that hold items whole, with words left out, or scattered."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    rng, made = np.random.default_rng(5), []
    for i, row in enumerate(benchmark.orderBy("item_id").collect()):
        words = row["text"].split()
        filler = [f"filler{rng.integers(9)}" for _ in range(60)]
        kept = [w for w in words if rng.random() > (0.0, 0.1, 0.5)[i % 3]]
        made.append((10_000 + i, " ".join([*filler[:30], *kept, *filler[30:]])))
    planted = spark.createDataFrame(made, "doc_id long, text string")
    return documents.withColumn("doc_id", F.col("doc_id").cast("long")).union(planted), benchmark


def test_items_are_found_as_by_comparing_all_with_all(spark, tables):
    docs, benchmark = tables
    found = {r["doc_id"]: set(r["items"]) for r in D.find_items(docs, benchmark).collect()}
    items = {r["item_id"]: item_parts(r["text"]) for r in benchmark.collect() if spoken(r["text"])}
    n = 0
    for row in docs.collect():
        words = spoken(row["text"])
        for key, item in items.items():
            length = len(item[0])
            # Whatever counts within the item's own length of words lies in one of these.
            windows = [words[low : low + 2 * length] for low in range(0, max(len(words) - length, 1), length)]
            if any(could(item, w, D.PARAPHRASED) and holds(item, w) for w in windows):
                n += 1
                assert key in found[row["doc_id"]], (row["doc_id"], key)
            elif key in found[row["doc_id"]] and item[1]:
                assert holds(item, words), (row["doc_id"], key)
    assert n > len(items) / 2


def test_places_reach_every_passage_judged_on_them():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n, longest = int(rng.integers(1, 400)), int(rng.integers(1, 60))
        begins = np.arange(0, n, D.HALF)
        low = rng.integers(0, n, 3)
        high = np.minimum(low + rng.integers(0, 120, 3), n - 1)
        wanted = [
            any(b - longest <= x and y < b + 2 * D.HALF + longest for x, y in zip(low, high, strict=True)) for b in begins
        ]
        assert D._within_reach(begins, low, high, longest, n).tolist() == wanted


def test_the_basis_leaves_the_driver_little_to_hold(spark):
    """The pipeline's driver was stopped above its memory while it factorised the table whole."""
    passages = spark.createDataFrame([([i % 7, i, 3 * i],) for i in range(40)], "features array<long>")
    tracemalloc.start()
    basis = D.latent_basis(passages, np.ones(D.FEATURES, dtype=np.float32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * basis.nbytes
    found = D._vectors([r.features for r in passages.collect()], np.ones(D.FEATURES, dtype=np.float32))
    assert np.abs(found @ basis @ basis.T - found).max() < 1e-4


@pytest.mark.parametrize("rank", [1, 9, 20])
def test_columns_made_orthonormal_span_what_they_did(rank):
    random = np.random.default_rng(1)
    scales = 10.0 ** -np.linspace(0, 4, 20)
    table = random.normal(size=(D.FEATURES, rank)) @ (random.normal(size=(rank, 20)) * scales)
    made = D._orthonormal(table.astype(np.float32))
    held = np.linalg.norm(made, axis=0) > 0.5
    assert held.sum() >= rank and np.abs(made[:, held].T @ made[:, held] - np.eye(held.sum())).max() < 1e-4
    assert np.linalg.norm(table - made @ (made.T @ table)) < 1e-5 * np.linalg.norm(table)
