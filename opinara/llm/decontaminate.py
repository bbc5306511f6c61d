"""Benchmark decontamination by latent semantic retrieval.

Texts and benchmark items are cut into passages of ``2 * HALF`` words that overlap
by half. A passage is a TF-IDF vector over hashed words, with document
frequencies counted over all texts. A randomised SVD of the benchmark's passages,
its products summed up over Spark's partitions, gives a latent space; every
passage of every text is projected into it and compared by cosine with every item
passage, block of items by block. Items above ``COSINE`` are candidates.

The space keeps less of each item the more items there are, so a second path finds
candidates without it. What counts as a copy holds all but a fifth of the item's
words; of its rarest words, one more than a fifth of all, at least one is therefore
there, and of ``n`` more at least ``n``. These words are looked up one by one, and
an item is a candidate wherever enough of them lie within twice its length. The same
is done for paraphrases, with the item's words or its answer's. So nothing that
counts is missed if it is spread over at most twice as many words as the item has.

The words around the passage or the rare words decide:

* a longest common subsequence with ``COPIED`` of the item's words is a copy;
* one with ``PARAPHRASED`` of them is a paraphrase if the item's answer, its last
  sentence, is there too with ``ANSWERED`` of its words in order. An item of one
  sentence has no answer of its own; the quarter of its words that the fewest texts
  have, three at least, stands for it.

A passage is projected only if the words it would be judged on hold enough rare words
of some item; on others no judgement could find one.

The item table is the query set: it is held in blocks of ``ITEM_BLOCK`` passages, one
broadcast at a time; the distinct words of all items are counted in the texts. The
latent basis has a fixed size, features by dimensions.

Words compare in lower case without marks at their ends. Null or empty texts hold
nothing; null or wordless items match nothing; items with equal texts all match.
Repeated rows are judged one by one. Empty tables give no rows or no matches.
Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

FEATURES = 1 << 14
DIMENSIONS, SURPLUS, ITERATIONS = 160, 16, 2
HALF = 24
LEAST_RARE = 3
COSINE = 0.3
COPIED, PARAPHRASED, ANSWERED = 0.8, 0.6, 0.8
ITEM_BLOCK = 8192
# Item passages made vectors at a time, each of 4 * FEATURES bytes, and rows of a table of FEATURES turned at a time.
VECTORS, TURNED = 32, 1 << 11
# Bytes of text worked on at a time: a word takes 4 * DIMENSIONS bytes.
SLICE = 1 << 19
MARKS = b".,;:!?\"'()[]{}*#$%&-_"
_MARK = np.isin(np.arange(256), list(MARKS))
# Rare words of an item asked for at once, and the words they may lie apart, in its lengths.
TOGETHER, REACH = 4, 2
FOUND = "doc_id long, row long, items array<long>, likeness double"


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (FEATURES.bit_length() - 1))).astype(np.int64)


def _bare(word: bytes) -> bytes:
    return word.strip(MARKS) or word


def _bare_hashes(texts: T.Texts, words: T.Words, sums: np.ndarray) -> np.ndarray:
    """Hashes of the words without marks at their ends, as ``_bare`` leaves them."""
    mark, at = _MARK[texts.data], np.arange(len(texts.data))
    before = np.maximum.accumulate(np.where(mark, -1, at))
    after = np.minimum.accumulate(np.where(mark, len(at), at)[::-1])[::-1]
    starts, ends = after[words.starts], before[words.ends - 1] + 1
    marks = starts >= words.ends
    return T.span_hashes(sums, np.where(marks, words.starts, starts), np.where(marks, words.ends, ends))


def _hashes_of(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, dtype=np.uint64)
    texts = next(T.slices(pa.array([b" ".join(words)], pa.large_binary())))
    return T.word_hashes(texts, T.split_words(texts))


class _Lookup:
    """Where hashes stand in a sorted table."""

    def __init__(self, table: np.ndarray):
        self.table, self.low = table, np.uint64((1 << 20) - 1)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[table & self.low] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.seen[hashes & self.low])
        where = np.searchsorted(self.table, hashes[at])
        held = self.table[np.minimum(where, len(self.table) - 1)] == hashes[at]
        return at[held], where[held]


def _document_frequency(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = _Lookup(sent.value)
        size = len(named.table)
        total, n = np.zeros(FEATURES + size, dtype=np.int64), 0
        for batch in batches:
            for texts in T.slices(batch.column(0)):
                texts = T.lowered(texts)
                words, sums = T.split_words(texts), texts.prefix_hashes()
                text_of = words.text_of()
                own = _features(T.span_hashes(sums, words.starts, words.ends)) + text_of * FEATURES
                total[:FEATURES] += np.bincount(np.unique(own) % FEATURES, minlength=FEATURES)
                at, where = named.find(_bare_hashes(texts, words, sums))
                if len(at):
                    total[FEATURES:] += np.bincount(np.unique(text_of[at] * size + where) % size, minlength=size)
                n += texts.high - texts.low
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["n", "texts"])

    return count


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<i8").astype(np.float64) for x in table.column("n").to_pylist())
    return pa.table({"n": pa.array([total.tobytes()], pa.binary()), "texts": pa.array([sum(table.column("texts").to_pylist())], pa.int64())})


def inverse_frequency(texts: DataFrame, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the hashed words over all texts; shares of texts that have each of the ``named``."""
    sent = texts.sparkSession.sparkContext.broadcast(named)
    parts = texts.mapInArrow(_document_frequency(sent), "n binary, texts long")
    # Partial sums in groups first, so that no task adds up all partitions' tables.
    parts = parts.withColumn("g", F.spark_partition_id() % 64).groupBy("g").applyInArrow(_summed, "n binary, texts long")
    held, n = np.zeros(FEATURES + len(named)), 0
    for row in parts.toLocalIterator():
        held, n = held + np.frombuffer(bytes(row.n), "<f8"), n + row.texts
    return np.log((n + 1) / (held[:FEATURES] + 1)).astype(np.float32), (held[FEATURES:] + 1) / (n + 1)


def _item_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Item passages as feature lists, with the words to compare on the first."""
    for batch in batches:
        rows = []
        for item, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held = (held or b"").lower()
            words = held.split()
            if not words:
                continue
            texts = next(T.slices(pa.array([held], pa.binary())))
            features = _features(T.word_hashes(texts, T.split_words(texts)))
            sentences = [s.split() for s in re.split(rb"[.!?\n]+(?=\s|$)", held) if s.split()]
            answer = [_bare(w) for w in sentences[-1]] if len(sentences) > 1 else []
            for low in range(0, max(len(words) - HALF, 1), HALF):
                own = features[low : low + 2 * HALF].tolist()
                rows.append((item, own, [_bare(w) for w in words], answer))
        columns = zip(*rows, strict=True) if rows else [()] * 4
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "features", "words", "answer"]
        )


def _vectors(lists: list[list[int]], weight: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors as rows of a dense table; few rows at a time."""
    made = np.zeros((len(lists), FEATURES), dtype=np.float32)
    for i, own in enumerate(lists):
        np.add.at(made[i], own, weight[own])
    norms = np.linalg.norm(made, axis=1, keepdims=True)
    return made / np.where(norms > 0, norms, 1)


def _summed_piece(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in table.column("n").to_pylist())
    return pa.table({"low": table.column("low").slice(0, 1), "n": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def _orthonormal(table: np.ndarray) -> np.ndarray:
    """``table`` with its columns made orthonormal in place, by the eigenvectors of their products.

    Columns beyond the rank become zero. A factorisation of the whole table would hold
    several copies of it in double precision. The second round takes off what rounding left.
    """
    for _ in range(2):
        products = np.zeros((table.shape[1], table.shape[1]))
        for low in range(0, len(table), TURNED):
            rows = table[low : low + TURNED].astype(np.float64)
            products += rows.T @ rows
        values, vectors = np.linalg.eigh(products)
        held = values > 1e-13 * max(values[-1], 1e-300)
        turn = np.where(held, vectors / np.sqrt(np.where(held, values, 1.0)), 0.0)
        for low in range(0, len(table), TURNED):
            table[low : low + TURNED] = table[low : low + TURNED] @ turn
    return table


def latent_basis(passages: DataFrame, weight: np.ndarray) -> np.ndarray:
    """Randomised SVD: the leading right singular vectors, features by dimensions.

    Each partition adds A'(A Q) over its rows; the sum, of a size that the data
    does not change, comes to the driver in pieces, is made orthonormal there and goes round again.
    """
    size = DIMENSIONS + SURPLUS
    random, basis = np.random.default_rng(3), np.empty((FEATURES, size), dtype=np.float32)
    for low in range(0, FEATURES, TURNED):
        basis[low : low + TURNED] = random.normal(size=(TURNED, size))
    basis = _orthonormal(basis)
    for last in [False] * ITERATIONS + [True]:
        sent = passages.sparkSession.sparkContext.broadcast(basis)

        def multiply(batches, sent=sent, last=last):
            total = np.zeros((size, size) if last else (FEATURES, size))
            for batch in batches:
                lists = batch.column(0).to_pylist()
                for low in range(0, len(lists), VECTORS):
                    rows = _vectors(lists[low : low + VECTORS], weight)
                    projected = rows @ sent.value
                    total += projected.T @ projected if last else rows.T @ projected
            total = total.astype("<f4")
            for low in range(0, len(total), TURNED):
                piece = total[low : low + TURNED].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), pa.array([piece], pa.binary())], names=["low", "n"])

        parts = passages.select("features").mapInArrow(multiply, "low long, n binary")
        total = np.zeros((size, size) if last else (FEATURES, size), dtype=np.float64 if last else np.float32)
        for row in parts.groupBy("low").applyInArrow(_summed_piece, "low long, n binary").toLocalIterator():
            piece = np.frombuffer(row.n, "<f4").reshape(-1, size)
            total[row.low : row.low + len(piece)] = piece
        if not last:
            basis = _orthonormal(total)
    values, turned = np.linalg.eigh(total)
    return (basis @ turned[:, ::-1][:, :DIMENSIONS]).astype(np.float32)


def common_subsequence(positions: dict[bytes, int], length: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence; ``positions`` has a bit for each place of a word."""
    row = full = (1 << length) - 1
    for word in words:
        held = positions.get(word, 0)
        if held:
            kept = row & held
            row = ((row + kept) | (row - kept)) & full
    return length - row.bit_count()


def _places(words: list[bytes]) -> dict[bytes, int]:
    made: dict[bytes, int] = {}
    for i, word in enumerate(words):
        made[word] = made.get(word, 0) | 1 << i
    return made


def judged(item: tuple, words: list[bytes]) -> float:
    """Share of the item's words found in order if it counts as contaminating, else 0."""
    (places, length), (answer_places, answer_length) = item
    share = common_subsequence(places, length, words) / length
    if share >= COPIED:
        return share
    if share >= PARAPHRASED and answer_length:
        if common_subsequence(answer_places, answer_length, words) >= ANSWERED * answer_length:
            return share
    return 0.0


def _needed(n: int, share: float) -> int:
    """The fewest of ``n`` words that are ``share`` of them."""
    least = int(share * n)
    while least < share * n and least / n < share:
        least += 1
    return max(least, 1)


def _probe(hashes: np.ndarray, shares: np.ndarray, needed: int) -> tuple[float, np.ndarray, int]:
    """What asking for it costs; rare words; how many of them are there if ``needed`` of all words are."""
    order, spare = np.argsort(shares, kind="stable"), len(hashes) - needed
    made = []
    for least in range(1, min(TOGETHER, needed) + 1):
        own = order[: spare + least]
        rate = float(shares[own].sum())
        made.append((rate * min(rate, 1.0) ** (least - 1), least, own))
    cost, least, own = min(made, key=lambda m: m[:2])
    return cost, np.unique(hashes[own]), least


def _rarest(words: list[bytes], named: np.ndarray, shares: np.ndarray) -> list[bytes]:
    """The words that stand for a missing answer, in their order."""
    common = shares[np.searchsorted(named, _hashes_of(words))]
    held = np.argsort(common, kind="stable")[: max(len(words) // 4, LEAST_RARE)]
    return [words[i] for i in sorted(held)]


class _Probes:
    """Rare words of the items, and what each asks for."""

    def __init__(self, texts: dict[int, tuple], named: np.ndarray, shares: np.ndarray):
        keys, probes, self.items, self.least, self.reach = [], [], [], [], []
        for item, (words, answer) in texts.items():
            hashes, own = _hashes_of(words), _hashes_of(answer)
            common, rare = (shares[np.searchsorted(named, h)] for h in (hashes, own))
            asked = [_probe(hashes, common, _needed(len(words), COPIED))]
            if answer:
                whole = _probe(hashes, common, _needed(len(words), PARAPHRASED))
                asked.append(min(whole, _probe(own, rare, _needed(len(answer), ANSWERED)), key=lambda p: p[0]))
            for _, rarest, least in asked:
                keys.append(rarest)
                probes.append(np.full(len(rarest), len(self.items)))
                self.items.append(item)
                self.least.append(least)
                self.reach.append(REACH * len(words))
        keys, probes = np.concatenate(keys), np.concatenate(probes)
        order = np.argsort(keys, kind="stable")
        self.words, first = np.unique(keys[order], return_index=True)
        self.first, self.probes = np.append(first, len(keys)), probes[order]
        self.least, self.reach = np.array(self.least), np.array(self.reach)

    def places(self, lookup: _Lookup, hashes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where enough rare words of a probe follow each other in a text: first one, last one, probe."""
        at, where = lookup.find(hashes)
        counts = self.first[where + 1] - self.first[where]
        total = int(counts.sum())
        own = self.probes[np.arange(total) + np.repeat(self.first[where] - (np.cumsum(counts) - counts), counts)]
        order = np.argsort(own, kind="stable")
        own, at = own[order], np.repeat(at, counts)[order]
        last = np.arange(total) + self.least[own] - 1
        held = np.flatnonzero(last < total)
        last = last[held]
        held_at, last_at = at[held], at[last]
        enough = (own[last] == own[held]) & (text_of[last_at] == text_of[held_at])
        return held_at[enough], last_at[enough], own[held][enough]


def _within_reach(begins: np.ndarray, low: np.ndarray, high: np.ndarray, longest: int, n_words: int) -> np.ndarray:
    """Which passages would be judged on words that hold both ends of a place."""
    least = np.maximum(high - 2 * HALF - longest + 1, 0)
    most = np.minimum(low + longest, n_words - 1)
    held = least <= most
    covered = np.bincount(least[held], minlength=n_words + 1) - np.bincount(most[held] + 1, minlength=n_words + 1)
    return np.cumsum(covered)[begins] > 0


def _search(sent):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(sent.value[5].words)
        for batch in batches:
            for texts in T.slices(batch.column(2), SLICE):
                texts = T.lowered(texts)
                words = T.split_words(texts)
                found: dict[int, dict[int, float]] = {}
                if len(words.starts):
                    _match(texts, words, found, lookup)
                n = texts.high - texts.low
                held = [found.get(i, {}) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.low, n), batch.column(1).slice(texts.low, n),
                        pa.array([sorted(h) for h in held], pa.list_(pa.int64())),
                        pa.array([max(h.values(), default=0.0) for h in held], pa.float64()),
                    ],
                    names=["doc_id", "row", "items", "likeness"],
                )

    def _match(texts: T.Texts, words: T.Words, found: dict[int, dict[int, float]], lookup: _Lookup) -> None:
        items, owners, targets, projection, weight, probes = sent.value
        longest = max((item[0][1] for item in items.values()), default=0)
        sums = texts.prefix_hashes()

        def judge(text: int, item: int, low: int, high: int) -> None:
            low, high = max(low, int(words.first[text])), min(high, int(words.first[text + 1]))
            span = texts.data[words.starts[low] : words.ends[high - 1]].tobytes()
            share = judged(items[item], [_bare(w) for w in span.split()])
            if share > found.get(text, {}).get(item, 0.0):
                found.setdefault(text, {})[item] = share

        text_of = words.text_of()
        low, high, asked = probes.places(lookup, _bare_hashes(texts, words, sums), text_of)
        near = high - low <= probes.reach[asked]
        for place, probe in zip(low[near], asked[near], strict=True):
            text, item, reach = int(text_of[place]), probes.items[probe], int(probes.reach[probe])
            if found.get(text, {}).get(item) != 1.0:
                judge(text, item, int(place) - reach, int(place) + reach + 1)
        # Halves of passages: the first word of each, and the text it is in.
        counts = -(-words.counts // HALF)
        first = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(len(counts)), counts)
        begins = words.first[:-1][owner] + (np.arange(first[-1]) - first[:-1][owner]) * HALF
        follows = np.zeros(len(begins), dtype=bool)
        follows[:-1] = owner[1:] == owner[:-1]
        # A passage with too few rare words around it holds no item, whatever its likeness.
        able = _within_reach(begins, low, high, longest, len(words.starts))
        wanted = able.copy()
        wanted[1:] |= able[:-1] & follows[:-1]
        able = able[wanted]
        if not len(able):
            return
        lengths = np.diff(np.append(begins, len(words.starts)))
        held = np.flatnonzero(np.repeat(wanted, lengths))
        begins, owner, follows, lengths = begins[wanted], owner[wanted], follows[wanted], lengths[wanted]
        features = _features(T.span_hashes(sums, words.starts[held], words.ends[held]))
        heads = np.cumsum(lengths) - lengths
        halves = np.add.reduceat(projection[features], heads, axis=0)
        squares = np.add.reduceat(weight[features] ** 2, heads)
        joins = np.flatnonzero(able & follows)
        passages, norms = halves.copy(), squares.copy()
        passages[joins] += halves[joins + 1]
        norms[joins] += squares[joins + 1]
        passages, norms, begins, owner = passages[able], norms[able], begins[able], owner[able]
        likeness = passages @ targets.T
        likeness /= np.sqrt(np.maximum(norms, 1e-12))[:, None]
        at, which = np.nonzero(likeness >= COSINE)
        for i, item in sorted({(i, owners[j]) for i, j in zip(at.tolist(), which.tolist(), strict=True)}):
            text = int(owner[i])
            if item in found.get(text, {}):
                continue
            judge(text, item, int(begins[i]) - longest, int(begins[i]) + 2 * HALF + longest)

    return search


def find_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, row, items, likeness`` for each row, ``row`` being a hash of its text.

    Several blocks of items are several passes over the texts, whose results are
    put together by document and text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"),
        F.col(text).cast("binary").alias("text"),
    )
    items = benchmark.select(F.col(item_key).cast("long"), F.col(item_text).cast("binary"))
    passages = materialise(
        items.mapInArrow(_item_passages, "item long, features array<long>, words array<binary>, answer array<binary>")
        .where("item is not null"),
        "item_passages",
    )
    named = passages.select(F.explode("words").alias("word")).distinct().toArrow().column("word")
    named = np.unique(_hashes_of(named.to_pylist()))
    weight, shares = inverse_frequency(rows.select("text"), named)
    basis = latent_basis(passages, weight)
    parts = [rows.mapInArrow(_search(sent), FOUND) for sent in _blocks(spark, passages, basis, weight, named, shares)]
    if not parts:
        nothing = F.array().cast("array<long>").alias("items")
        return rows.select("doc_id", "row", nothing, F.lit(0.0).alias("likeness"))
    if len(parts) == 1:
        return parts[0]
    every = parts[0].withColumn("part", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        every = every.unionByName(part.withColumn("part", F.lit(i)))
    # Repeated rows come as often from every block.
    copies = F.expr(f"sequence(1, cast(n div {len(parts)} as int))")
    merged = every.groupBy("doc_id", "row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max("likeness").alias("likeness"), F.count("*").alias("n"),
    )
    return merged.withColumn("copy", F.explode(copies)).drop("copy", "n")


def _blocks(spark, passages: DataFrame, basis: np.ndarray, weight: np.ndarray, named: np.ndarray, shares: np.ndarray):
    """Broadcasts of the item passages, ``ITEM_BLOCK`` at a time."""
    held: list = []
    projection = basis * weight[:, None]

    def made(rows):
        vectors = np.concatenate(
            [_vectors([r.features for r in rows[i : i + VECTORS]], weight) @ basis for i in range(0, len(rows), VECTORS)]
        )
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        targets = (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)
        items, held = {}, {}
        for r in rows:
            words, answer = [bytes(w) for w in r.words], [bytes(w) for w in r.answer]
            answer = answer or _rarest(words, named, shares)
            items[r.item] = ((_places(words), len(words)), (_places(answer), len(answer)))
            held[r.item] = words, answer
        probes = _Probes(held, named, shares)
        return spark.sparkContext.broadcast((items, [r.item for r in rows], targets, projection, weight, probes))

    for row in passages.toLocalIterator():
        held.append(row)
        if len(held) == ITEM_BLOCK:
            yield made(held)
            held = []
    if held:
        yield made(held)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``key, contaminated, items, likeness`` for each row; ``items`` the keys found."""
    key = options.get("key", "doc_id")
    return find_items(docs, benchmark, **options).select(
        F.col("doc_id").alias(key), (F.size("items") > 0).alias("contaminated"), "items", "likeness"
    )
