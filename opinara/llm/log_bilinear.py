"""Scoring texts with a log-bilinear neural model trained by noise-contrastive estimation.

Every word maps to a unit: the ``TOP`` most frequent words of the training texts
have a unit each, all others share ``CLASSES`` units by the hash of their last two
bytes. The model gives the next unit's probability from the unit before,

    log p(next | before) ~ r_before . C . q_next + b_next,

normalised over all units by a batched matrix product. A word that shares its
unit has within it the share (c + 1) / (sum over the unit's words (c + 1) + 1), so
probabilities over all words, and one unknown word in each shared unit, sum to 1.

The parameters are learnt in numpy from the counts of neighbouring units in all
training texts, which is all the loss needs: the expected noise-contrastive loss
with unigram noise is a sum over pairs of units. Those counts, units by units, are
the only thing that comes to the driver, and their size is fixed.

Counts of words grow with the corpus and stay distributed. Texts are coded in
chunks: a chunk's distinct words go, sorted and packed, to shards of the hash
space, a shard adds the counts up and answers each chunk for its words. A word is
sent once for a chunk, so a frequent one weighs on its shard no more than others.

Null text: empty, scored as the end alone. Null key: its text form is empty, which
makes it a training row. Repeated rows count and score one by one. An empty table
gives no rows; without training texts all counts are 0. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

TOP = 768
CLASSES = 256
UNITS = TOP + CLASSES
DIMENSIONS = 32
STEPS = 150
NOISE = 20.0
RATE = 0.05
SLICE = 4 << 20
# Keys of all chunks that one shard adds up, about.
SHARD_KEYS = 1 << 20
HELD_OUT_OF, HELD_OUT = 7, 2
END = np.uint64(0x5E17D2A9C3B4F601)

CODED = """chunk long, doc_ids array<long>, held array<boolean>, lengths array<int>, n_keys long,
    codes binary, keys binary, counts binary, classes binary"""
ANSWERED = "chunk long, shard int, counts binary, kind int, key long, value long, class int"
SCORED = """doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"""
BLOCK = 64


def held_out(doc_id: int | None) -> bool:
    name = "" if doc_id is None else str(doc_id)
    return zlib.crc32(name.encode()) % HELD_OUT_OF == HELD_OUT


def _pack(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=kind)


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk: its texts as numbers into its sorted distinct words."""
    made = 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for texts in T.slices(batch.column(1), SLICE):
            own = ids[texts.low : texts.high]
            texts = T.lowered(texts)
            words = T.split_words(texts)
            hashes = T.word_hashes(texts, words)
            n, counts = len(own), words.counts
            tail = texts.data[words.ends - 1].astype(np.uint64)
            before = np.where(words.ends - words.starts > 1, texts.data[np.maximum(words.ends - 2, 0)], 0)
            kinds = (T.mix(tail * np.uint64(256) + before.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.uint8)
            # Each text's words, then its end.
            at = np.arange(len(hashes)) + np.repeat(np.arange(n), counts)
            every, every_kinds = np.full(len(hashes) + n, END), np.zeros(len(hashes) + n, np.uint8)
            every[at], every_kinds[at] = hashes, kinds
            keys, first, codes = np.unique(every, return_index=True, return_inverse=True)
            held = np.array([held_out(i) for i in own], dtype=bool)
            trains = np.repeat(~held, counts + 1)
            seen = np.bincount(codes[trains], minlength=len(keys))
            row = {
                "chunk": [(TaskContext.get().partitionId() << 32) + made],
                "doc_ids": [own], "held": [held.tolist()], "lengths": [(counts + 1).tolist()],
                "n_keys": [len(keys)], "codes": [_pack(codes, "<u4")], "keys": [keys.astype("<u8").tobytes()],
                "counts": [_pack(seen, "<u8")], "classes": [every_kinds[first].tobytes()],
            }
            made += 1
            yield pa.RecordBatch.from_pydict(row, schema=_CODED)


_CODED = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())), ("n_keys", pa.int64()), ("codes", pa.binary()),
        ("keys", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary()),
    ]
)
_ANSWERED = pa.schema(
    [
        ("chunk", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary()), ("kind", pa.int32()),
        ("key", pa.int64()), ("value", pa.int64()), ("class", pa.int32()),
    ]
)


def _deal(bits: int):
    """Cut a chunk's sorted words into the shards' ranges."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
        for batch in batches:
            for chunk, keys, counts, kinds in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held, seen = np.frombuffer(keys, "<u8"), _unpack(counts, "<u8")
                cuts = np.concatenate([[0], np.searchsorted(held, bounds), [len(held)]])
                rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(rows), pa.int64()), pa.array([s for s, _, _ in rows], pa.int32()),
                        pa.array([held[a:b].tobytes() for _, a, b in rows], pa.binary()),
                        pa.array([_pack(seen[a:b], "<u8") for _, a, b in rows], pa.binary()),
                        pa.array([kinds[a:b] for _, a, b in rows], pa.binary()),
                    ],
                    names=["chunk", "shard", "keys", "counts", "classes"],
                )

    return deal


# Kinds of rows beside the answers: distinct words, tokens, a unit's mass, a frequent word.
DISTINCT, TOKENS, MASS, FREQUENT = range(4)


def _add_up(table: pa.Table) -> pa.Table:
    """Answer each chunk of a shard; add the shard's share of the statistics."""
    chunks, shard = table.column("chunk").to_pylist(), table.column("shard")[0].as_py()
    keys = [np.frombuffer(k, "<u8") for k in table.column("keys").to_pylist()]
    counts = [_unpack(c, "<u8") for c in table.column("counts").to_pylist()]
    kinds = np.frombuffer(b"".join(table.column("classes").to_pylist()), np.uint8)
    distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    rows = [(c, shard, _pack(x, "<u8"), None, None, None, None) for c, x in zip(chunks, np.split(total[at], cuts), strict=True)]
    known, kind = total > 0, kinds[first]
    rows.append((None, shard, None, DISTINCT, None, int(known.sum()), None))
    rows.append((None, shard, None, TOKENS, None, int(total.sum()), None))
    mass = np.bincount(kind[known], total[known] + 1, CLASSES).astype(np.int64)
    rows += [(None, shard, None, MASS, None, int(m), i) for i, m in enumerate(mass) if m]
    signed = distinct.view(np.int64)
    most = np.lexsort((signed, -total))[:TOP]
    rows += [
        (None, shard, None, FREQUENT, int(signed[i]), int(total[i]), int(kind[i])) for i in most if total[i]
    ]
    columns = zip(*rows, strict=True)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ANSWERED, strict=True)], schema=_ANSWERED)


class Vocabulary:
    """Units of words: the frequent ones' keys in order with their units, else the class."""

    def __init__(self, keys: list[int], classes: list[int], mass: dict[int, int], counts: list[int]):
        held = np.array(keys, dtype=np.int64).view(np.uint64)
        order = np.argsort(held)
        self.keys, self.units = held[order], np.arange(len(held))[order]
        self.mass = np.ones(CLASSES)  # the unknown word of each shared unit
        for i, m in mass.items():
            self.mass[i] += m
        for kind, count in zip(classes, counts, strict=True):
            self.mass[kind] -= count + 1

    def units_of(self, keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
        units = TOP + classes.astype(np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            units = np.where(self.keys[at] == keys, self.units[at], units)
        return units


def _neighbours(units: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The unit before each token; before a text's first stands the begin, ``UNITS``."""
    before = np.concatenate([[UNITS], units[:-1]])
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = UNITS
    return before


def _count_pairs(vocabulary: Vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((UNITS + 1) * UNITS, dtype=np.int64)
        for batch in batches:
            for keys, kinds, codes, lengths, held in zip(
                *(batch.column(i).to_pylist() for i in range(5)), strict=True
            ):
                own = vocabulary.units_of(np.frombuffer(keys, "<u8"), np.frombuffer(kinds, np.uint8))
                units, lengths = own[_unpack(codes, "<u4")], np.array(lengths)
                trains = np.repeat(~np.array(held, dtype=bool), lengths)
                pairs = (_neighbours(units, lengths) * UNITS + units)[trains]
                total += np.bincount(pairs, minlength=len(total))
        size = BLOCK * UNITS
        for block, low in enumerate(range(0, len(total), size)):
            part = total[low : low + size]
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int32()), pa.array([_pack(at, "<u4")], pa.binary()),
                        pa.array([_pack(part[at], "<u8")], pa.binary()),
                    ],
                    names=["block", "at", "n"],
                )

    return count


def _add_pairs(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK * UNITS, dtype=np.int64)
    for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist(), strict=True):
        total[_unpack(at, "<u4")] += _unpack(n, "<u8").astype(np.int64)
    return pa.table({"block": table.column("block")[:1], "n": pa.array([_pack(total, "<u8")], pa.binary())})


def train(pairs: np.ndarray, steps: int = STEPS, noise: float = NOISE, seed: int = 5) -> np.ndarray:
    """Log probabilities of each unit after each unit, from counts of neighbours.

    Minimises the expected noise-contrastive loss: each pair seen, against
    ``noise`` pairs with the next unit drawn from the unigram distribution.
    """
    rng = np.random.default_rng(seed)
    n_before, n = pairs.shape
    total = max(pairs.sum(), 1)
    unigram = ((pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * n)).astype(np.float32)
    seen, before = (pairs / total).astype(np.float32), (pairs.sum(axis=1) / total).astype(np.float32)
    values = {
        "r": rng.normal(0, 0.3, (n_before, DIMENSIONS)).astype(np.float32),
        "c": np.eye(DIMENSIONS, dtype=np.float32),
        "q": rng.normal(0, 0.1, (n, DIMENSIONS)).astype(np.float32),
        "b": np.log(unigram),
    }
    means = {k: np.zeros_like(v) for k, v in values.items()}
    squares = {k: np.zeros_like(v) for k, v in values.items()}
    offset = np.log(noise * unigram)
    against = noise * before[:, None] * unigram[None, :]
    for step in range(1, steps + 1):
        r, c, q, b = values["r"], values["c"], values["q"], values["b"]
        predicted = r @ c
        true = 1 / (1 + np.exp(np.clip(offset - (predicted @ q.T + b), -60, 60)))
        slope = against * true - seen * (1 - true)
        back = slope @ q
        slopes = {"r": back @ c.T, "c": r.T @ back, "q": slope.T @ predicted, "b": slope.sum(axis=0)}
        for k, g in slopes.items():
            means[k] = 0.9 * means[k] + 0.1 * g
            squares[k] = 0.999 * squares[k] + 0.001 * g * g
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            high = np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-10
            values[k] = values[k] - (rate * means[k] / (1 - 0.9**step) / high).astype(np.float32)
    return log_probabilities(values)


def log_probabilities(values: dict[str, np.ndarray]) -> np.ndarray:
    """All normalised log probabilities by one matrix product."""
    scores = (values["r"] @ values["c"] @ values["q"].T + values["b"]).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _score(sent, tokens: int, distinct: int):
    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        vocabulary, table = sent.value
        if not chunk.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in _SCORED}, schema=_SCORED)
        row = chunk.to_pylist()[0]
        parts = sorted(zip(answers.column("shard").to_pylist(), answers.column("counts").to_pylist(), strict=True))
        counts = np.concatenate([_unpack(c, "<u8") for _, c in parts]).astype(np.float64)
        kinds = np.frombuffer(row["classes"], np.uint8)
        units = vocabulary.units_of(np.frombuffer(row["keys"], "<u8"), kinds)
        base = np.log10((counts + 1) / (tokens + distinct + 1))
        shared = np.where(units >= TOP, np.log10((counts + 1) / vocabulary.mass[kinds]), 0.0)
        codes, lengths = _unpack(row["codes"], "<u4"), np.array(row["lengths"])
        own = units[codes]
        log10 = table[_neighbours(own, lengths), own] / np.log(10) + shared[codes]
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return pa.Table.from_arrays(
            [
                pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                pa.array(lengths.astype(np.int64)),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64)[codes], first)),
                pa.array(np.add.reduceat(base[codes], first)), pa.array(np.add.reduceat(log10, first)),
            ],
            schema=_SCORED,
        )

    return score


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's log10 probability, by the model and by add-one unigrams."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    chunks = materialise(rows.mapInArrow(_code, CODED), "chunks")
    keys = chunks.agg(F.sum("n_keys")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(keys, 1) / SHARD_KEYS))))
    dealt = chunks.select("chunk", "keys", "counts", "classes").mapInArrow(
        _deal(bits), "chunk long, shard int, keys binary, counts binary, classes binary"
    )
    answered = materialise(dealt.groupBy("shard").applyInArrow(_add_up, ANSWERED), "answers")
    facts = answered.where(F.col("kind").isNotNull())
    sums = {
        (r.kind, r["class"]): r.total
        for r in facts.where(F.col("kind") != FREQUENT).groupBy("kind", "class").agg(F.sum("value").alias("total")).collect()
    }
    frequent = facts.where(F.col("kind") == FREQUENT).orderBy(F.desc("value"), "key").limit(TOP).collect()
    mass = {k: v for (kind, k), v in sums.items() if kind == MASS}
    vocabulary = Vocabulary(
        [r.key for r in frequent], [r["class"] for r in frequent], mass, [r.value for r in frequent]
    )
    paired = chunks.select("keys", "classes", "codes", "lengths", "held").mapInArrow(
        _count_pairs(vocabulary), "block int, at binary, n binary"
    )
    pairs = np.zeros(((UNITS + BLOCK) // BLOCK * BLOCK, UNITS), dtype=np.int64)
    # One row for each block of the fixed units-by-units table.
    for r in paired.groupBy("block").applyInArrow(_add_pairs, "block int, n binary").collect():
        held = _unpack(bytes(r.n), "<u8").astype(np.int64).reshape(BLOCK, UNITS)
        pairs[r.block * BLOCK : (r.block + 1) * BLOCK] = held
    table = train(pairs[: UNITS + 1]).astype(np.float32)
    tokens, distinct = sums.get((TOKENS, None), 0), sums.get((DISTINCT, None), 0)
    sent = spark.sparkContext.broadcast((vocabulary, table))
    answers = answered.where(F.col("chunk").isNotNull()).select("chunk", "shard", "counts")
    whole = chunks.drop("n_keys", "counts")
    scored = whole.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(sent, int(tokens), int(distinct)), SCORED
    )
    return scored.select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", "n_known",
        F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score",
    )
