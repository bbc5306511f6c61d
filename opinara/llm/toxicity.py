"""Toxicity by the nearest labelled examples, with the examples as evidence.

Words are runs of letters, digits and characters beyond ASCII, ``A-Z`` in lower case.
From the labelled rows, ``examples`` of each class are taken, those with the smallest
hashes of their key; that bound is the only one on what is learned from. The terms are
the words whose presence depends on the label by a likelihood-ratio test, at most
``TERMS`` of them; a text is the vector of its terms, ``(1 + ln tf) * idf``, of length
one, where ``idf`` counts the texts of the whole table that hold the term.

Each text gets its ``NEIGHBOURS`` nearest examples by exact cosine. The examples lie in
an inverted index, cut into blocks of ``BLOCK`` examples of like terms, with the
largest weight of each term in each block. The weights bound what a block can reach;
blocks are read from the highest bound down, until the bound of the next one is below
the last neighbour held, so what is left out cannot be nearer.

Neighbours vote with their cosine, against a constant weight for "not toxic", so that
far ones count little. Votes become probabilities by the share of toxic examples
among those of like votes, each example judged without itself, made monotone, with the
classes weighed as they are among all labelled rows.

The index and the table of votes go to each task; their size is bounded by ``examples``
and ``TERMS``. Texts are read where they lie, once, and nothing is shuffled but counts.

A text without a term, an empty one or a null one among them, has no neighbour and gets
the share of such examples. Equal cosines go by the example's key. Repeated rows are
scored each. Of several labels of a key the largest counts, null labels do not; of
several texts of a key the smallest is the example. Without labelled rows of both
classes every score is the share of the class there is, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.text import LOWER, Texts, slices, split_words, word_hashes
from opinara.session import materialise

# Labelled rows of each class that become examples.
EXAMPLES = 4096
TERMS = 1024
# Least likelihood ratio, twice its logarithm, of a term and the label.
LEAST_RATIO = 40.0
NEIGHBOURS = 15
BLOCK = 64
# What "not toxic" weighs beside the neighbours' cosines.
DOUBT = 1.0
# Votes are put in so many classes before they are made monotone.
VOTE_STEPS = 200
FOLDS, HELD_OUT_FOLD = 5, 0

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[48:58] = _WORD_BYTE[65:91] = _WORD_BYTE[97:123] = True
_WORD_BYTE[128:] = True
_AS_WORDS = np.where(_WORD_BYTE, LOWER, 32).astype(np.uint8)

VECTORS = "doc_id long, terms array<int>, counts array<int>"
RESULT = (
    "doc_id long, held_out boolean, score double, predicted int, vote double, "
    "evidence array<struct<doc_id: long, toxic: int, cosine: double>>"
)


def _words_only(texts: Texts) -> Texts:
    return Texts(texts.low, texts.high, _AS_WORDS[texts.data], texts.offsets)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, toxic``: each word of each text once."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic").cast(pa.int32()))
        for texts in slices(batch.column("text")):
            texts = _words_only(texts)
            words = split_words(texts)
            hashes, owner = word_hashes(texts, words), words.text_of()
            order = np.lexsort((hashes, owner))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(owner[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
            first = order[new]
            held = texts.data.tobytes()
            found = [held[a:b] for a, b in zip(words.starts[first], words.ends[first], strict=True)]
            labels = toxic[texts.low + owner[first]]
            yield pa.record_batch([pa.array(found, pa.binary()), pa.array(labels)], ["word", "toxic"])


def _ratio(with_1, n_1, with_0, n_0):
    """Twice the log of the likelihood ratio of a word's presence and the label, as a column."""
    total, held = n_1 + n_0, with_1 + with_0

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2.0 * (
        part(with_1, held * n_1 / total)
        + part(with_0, held * n_0 / total)
        + part(n_1 - with_1, (total - held) * n_1 / total)
        + part(n_0 - with_0, (total - held) * n_0 / total)
    )


def select_terms(examples: DataFrame, n_1: int, n_0: int, terms: int = TERMS) -> list[bytes]:
    """The words of ``examples`` (``text, toxic``) that depend most on the label, most first."""
    words = examples.select("text", "toxic").mapInArrow(_distinct_words, "word binary, toxic int")
    counted = words.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).cast("double").alias("with_1"),
        F.count_if(F.col("toxic") == 0).cast("double").alias("with_0"),
    )
    ratio = _ratio(F.col("with_1"), F.lit(float(n_1)), F.col("with_0"), F.lit(float(n_0)))
    chosen = counted.select("word", F.round(ratio, 6).alias("ratio")).where(F.col("ratio") >= LEAST_RATIO)
    return [bytes(r.word) for r in chosen.orderBy(F.desc("ratio"), "word").limit(terms).collect()]


def term_vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, terms, counts``: how often each text of ``docs`` (``doc_id, text``) has each term."""
    joined = b" ".join(terms)
    held = Texts(0, 1, np.frombuffer(joined, dtype=np.uint8), np.array([0, len(joined)], dtype=np.int64))
    hashes = word_hashes(held, split_words(held)) if terms else np.zeros(0, dtype=np.uint64)
    order = np.argsort(hashes)
    ranked = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                texts = _words_only(texts)
                words = split_words(texts)
                n = texts.high - texts.low
                keys, owner = word_hashes(texts, words), words.text_of()
                at = np.searchsorted(ranked, keys)
                known = np.flatnonzero(at < len(ranked))
                known = known[ranked[at[known]] == keys[known]]
                pairs, counts = np.unique(
                    owner[known].astype(np.int64) * TERM_SPACE + order[at[known]], return_counts=True
                )
                first = np.searchsorted(pairs, np.arange(n + 1, dtype=np.int64) * TERM_SPACE).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(texts.low, n),
                        pa.ListArray.from_arrays(first, (pairs % TERM_SPACE).astype(np.int32)),
                        pa.ListArray.from_arrays(first, counts.astype(np.int32)),
                    ],
                    ["doc_id", "terms", "counts"],
                )

    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return typed.mapInArrow(count, VECTORS)


def texts_by_term(vectors: DataFrame, n_terms: int) -> DataFrame:
    """``term, n``: how many texts have each term; a task adds up its own first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column("terms").flatten()), minlength=n_terms)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there.astype(np.int32)), pa.array(total[there])], ["term", "n"])

    return vectors.select("terms").mapInArrow(add, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


# Above any number of terms.
TERM_SPACE = 1 << 20


@dataclass
class Vectors:
    """Sparse rows of length one: each row's first entry, terms and weights."""

    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def weighed(terms: pa.Array, counts: pa.Array, idf: np.ndarray) -> Vectors:
    """Vectors of term counts."""
    if isinstance(terms, pa.ChunkedArray):
        terms, counts = terms.combine_chunks(), counts.combine_chunks()
    first = np.concatenate([[0], np.cumsum(np.asarray(terms.value_lengths().fill_null(0)))]).astype(np.int64)
    ids = np.asarray(terms.flatten()).astype(np.int64)
    weights = (1.0 + np.log(np.maximum(np.asarray(counts.flatten()), 1))) * idf[ids]
    made = Vectors(first, ids, weights)
    squares = np.bincount(made.owner, weights * weights, minlength=len(first) - 1)
    return Vectors(first, ids, weights / np.sqrt(squares)[made.owner])


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one range after the other."""
    before = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(before[-1]) + np.repeat(starts - before[:-1], lengths)


class BlockMaxIndex:
    """Examples by term in blocks, with each term's largest weight in each block."""

    def __init__(self, examples: Vectors, n_terms: int) -> None:
        n = len(examples.first) - 1
        self.size, self.n_terms = n, n_terms
        # Like examples lie together: by their heaviest term, then by their second.
        order = np.lexsort((-examples.weights, examples.owner))
        lead = np.full((n, 2), n_terms)
        place = np.arange(len(order)) - examples.first[examples.owner[order]]
        for k in (0, 1):
            at = order[place == k]
            lead[examples.owner[at], k] = examples.terms[at]
        self.number = np.lexsort((np.arange(n), lead[:, 1], lead[:, 0]))
        slot = np.empty(n, dtype=np.int64)
        slot[self.number] = np.arange(n)
        self.n_blocks = -(-n // BLOCK)
        slots = slot[examples.owner]
        cell = (slots // BLOCK) * n_terms + examples.terms
        by_cell = np.argsort(cell, kind="stable")
        self.slots, self.weights = slots[by_cell], examples.weights[by_cell]
        self.first = np.searchsorted(cell[by_cell], np.arange(self.n_blocks * n_terms + 1))
        self.most = np.zeros((n_terms, self.n_blocks))
        np.maximum.at(self.most, (examples.terms, slots // BLOCK), examples.weights)

    def bounds(self, texts: Vectors) -> np.ndarray:
        """What each text can reach in each block; above zero if they share a term."""
        out = np.zeros((len(texts.first) - 1, self.n_blocks))
        if len(texts.terms):
            reached = self.most[texts.terms] * texts.weights[:, None]
            filled = np.flatnonzero(np.diff(texts.first))
            out[filled] = np.add.reduceat(reached, texts.first[:-1][filled], axis=0)
        return out * (1 + 1e-9)

    def cosines(self, texts: Vectors, rows: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The cosines of each row with the ``BLOCK`` examples of one block."""
        lengths = texts.first[rows + 1] - texts.first[rows]
        entry = _ranges(texts.first[rows], lengths)
        ask = np.repeat(np.arange(len(rows)), lengths)
        cell = blocks[ask] * self.n_terms + texts.terms[entry]
        n_posted = self.first[cell + 1] - self.first[cell]
        posted = _ranges(self.first[cell], n_posted)
        target = np.repeat(ask, n_posted) * BLOCK + self.slots[posted] % BLOCK
        gained = np.repeat(texts.weights[entry], n_posted) * self.weights[posted]
        return np.bincount(target, gained, minlength=len(rows) * BLOCK).reshape(len(rows), BLOCK)

    def nearest(self, texts: Vectors, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each text's ``k`` nearest examples and their cosines, nearest first.

        Places without a neighbour have the cosine 0 and the number ``size``. ``without``
        names an example that each text leaves out. Cosines are compared as rounded to
        twelve digits, so that equal vectors tie; ties go by number.
        """
        n = len(texts.first) - 1
        best = np.zeros((n, k))
        names = np.full((n, k), self.size)
        if not self.size:
            return names, best
        bounds = self.bounds(texts)
        order = np.argsort(-bounds, axis=1, kind="stable")
        rows = np.arange(n)
        for step in range(self.n_blocks):
            blocks = order[rows, step]
            reach = bounds[rows, blocks]
            open_ = (reach > 0) & (reach + 1e-11 >= best[rows, -1])
            rows, blocks = rows[open_], blocks[open_]
            if not len(rows):
                break
            found = np.round(self.cosines(texts, rows, blocks), 12)
            slots = blocks[:, None] * BLOCK + np.arange(BLOCK)
            numbers = np.where(slots < self.size, self.number[np.minimum(slots, self.size - 1)], self.size)
            found[numbers == self.size] = 0.0
            if without is not None:
                found[numbers == without[rows][:, None]] = 0.0
            numbers[found <= 0] = self.size
            both = np.concatenate([best[rows], found], axis=1)
            called = np.concatenate([names[rows], numbers], axis=1)
            keep = np.lexsort((called, -both), axis=1)[:, :k]
            best[rows] = np.take_along_axis(both, keep, axis=1)
            names[rows] = np.take_along_axis(called, keep, axis=1)
        return names, best


def votes(names: np.ndarray, cosines: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The toxic share of the neighbours' cosines, with ``DOUBT`` for "not toxic"."""
    labelled = np.append(toxic, 0)[names]
    return (cosines * labelled).sum(axis=1) / (cosines.sum(axis=1) + DOUBT)


def monotone_shares(vote: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighed share of toxic examples for each class of votes, never falling.

    Classes of votes whose shares fall are pooled; those without an example lie on the
    line between their neighbours. Each pool counts half an example of the whole more.
    """
    step = _vote_step(vote)
    hits = np.bincount(step, weight * toxic, minlength=VOTE_STEPS + 1)
    mass = np.bincount(step, weight, minlength=VOTE_STEPS + 1)
    prior = (weight * toxic).sum() / weight.sum()
    pools: list[list[float]] = []  # toxic mass, mass, first and last class
    for at in np.flatnonzero(mass):
        pools.append([hits[at], mass[at], at, at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            high = pools.pop()
            pools[-1] = [pools[-1][0] + high[0], pools[-1][1] + high[1], pools[-1][2], high[3]]
    at = [end for pool in pools for end in pool[2:]]
    share = [(pool[0] + 0.5 * prior) / (pool[1] + 0.5) for pool in pools for _ in pool[2:]]
    shares = np.interp(np.arange(VOTE_STEPS + 1), at, share)
    return np.maximum.accumulate(np.clip(shares, 0.0, 1.0))


def _vote_step(vote: np.ndarray) -> np.ndarray:
    """A class of its own for no vote at all."""
    return np.where(vote > 0, 1 + np.minimum((vote * VOTE_STEPS).astype(np.int64), VOTE_STEPS - 1), 0)


@dataclass
class Model:
    """What the tasks need to score vectors."""

    idf: np.ndarray
    index: BlockMaxIndex
    keys: np.ndarray
    toxic: np.ndarray
    shares: np.ndarray

    def score(self, texts: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        names, cosines = self.index.nearest(texts, NEIGHBOURS)
        vote = votes(names, cosines, self.toxic)
        return self.shares[_vote_step(vote)], vote, names, cosines


def held_out(key: str = "doc_id") -> F.Column:
    """Rows whose labels nothing is learned from; a null key is not held out."""
    fold = F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def choose_examples(docs: DataFrame, labels: DataFrame, examples: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, toxic`` of the examples, and how many labelled rows each class has."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    marked = materialise(marked.join(there, "doc_id", "left_semi"), "labelled")
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marked.where(F.col("toxic") == label).orderBy(*order).limit(examples) for label in (0, 1)]
    # At most twice `examples` keys.
    keys = F.broadcast(materialise(chosen[0].unionByName(chosen[1]), "example_keys"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(keys, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return materialise(found, "examples"), sizes


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[Model, DataFrame]:
    """The model, and the written term counts of all of ``docs``."""
    chosen, sizes = choose_examples(docs, labels, examples)
    taken = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    both = taken.get(0, 0) and taken.get(1, 0)
    terms = select_terms(chosen, taken.get(1, 0), taken.get(0, 0)) if both else []
    vectors = materialise(term_vectors(docs, terms), "term_vectors")
    counted = texts_by_term(vectors, len(terms))
    n_texts = vectors.count()
    idf = np.zeros(len(terms))
    for row in counted.collect():  # a row for each term
        idf[row.term] = np.log((1 + n_texts) / (1 + row.n)) + 1.0
    held = term_vectors(chosen, terms).join(chosen.select("doc_id", "toxic"), "doc_id").orderBy("doc_id").toArrow()
    toxic = np.asarray(held.column("toxic")).astype(np.int64)
    rows = weighed(held.column("terms"), held.column("counts"), idf)
    index = BlockMaxIndex(rows, len(terms))
    names, cosines = index.nearest(rows, NEIGHBOURS, np.arange(len(toxic)))
    if len(toxic):
        weight = np.array([sizes.get(c, 0) / max(taken.get(c, 0), 1) for c in (0, 1)])[toxic]
        shares = monotone_shares(votes(names, cosines, toxic), toxic, weight)
    else:
        shares = np.zeros(VOTE_STEPS + 1)
    return Model(idf, index, np.asarray(held.column("doc_id")).astype(np.int64), toxic, shares), vectors


def score_texts(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """A score for every row of ``docs``, with the three nearest examples it rests on."""
    model, vectors = learn(docs, labels, examples)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        named = np.append(known.keys, -1)
        marked = np.append(known.toxic, 0).astype(np.int32)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                texts = weighed(part.column("terms"), part.column("counts"), known.idf)
                scores, vote, names, cosines = known.score(texts)
                names, cosines = names[:, :3], cosines[:, :3]
                there = cosines > 0
                first = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
                shown = pa.StructArray.from_arrays(
                    [pa.array(named[names[there]]), pa.array(marked[names[there]]), pa.array(cosines[there])],
                    ["doc_id", "toxic", "cosine"],
                )
                yield pa.record_batch(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)), pa.array(vote),
                        pa.ListArray.from_arrays(first, shown),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "vote", "evidence"],
                )

    return vectors.withColumn("held_out", held_out()).mapInArrow(score, RESULT)
