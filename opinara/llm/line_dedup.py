"""Removing repeated lines, copies and those within one word's edit of an earlier line.

A line is what stands between line feeds; its words, in lower case, are its
content. A line goes if an earlier one, by document key and line number, has the
same words or, both having ``LEAST_WORDS`` or more, is one word's insertion,
deletion or substitution away.

Equal lines are one from the start. Of distinct lines each emits its deletion
neighbourhood: the hash of all its words, and of its words without each one. Lines
with an equal variant are at most one edit apart if the same place was left out
or if one of them left out nothing, so the earliest line of each such variant is
enough to judge all others, however many share it. The edit is then verified on
the words.

Two lines one edit apart share their first or their last half, cut by the length
of the shorter; lines that share no half with another emit no variants.

Lines without words always stay. Null and empty texts have no line to lose. Rows
with equal keys and texts are one document; a null key comes after all others.
An empty table gives no rows. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

LEAST_WORDS = 6
LINES = "doc long, row long, line int, h1 long, h2 long, halves array<long>"
VARIANTS = "variant long, left_out int, doc long, row long, line int"
WORDED = "doc long, row long, line int, words binary"
LAST = (1 << 63) - 1


def _lines(texts: T.Texts) -> tuple[T.Texts, T.Words, np.ndarray, np.ndarray]:
    """Texts cut at line feeds: the lines as texts, their words, owner and number."""
    n = len(texts.offsets) - 1
    breaks = np.flatnonzero(texts.data == 10)
    owner = np.searchsorted(texts.offsets, breaks, side="right") - 1
    cuts = np.concatenate([texts.offsets[:-1], breaks + 1])
    owners = np.concatenate([np.arange(n), owner])
    order = np.lexsort((cuts, owners))
    cuts, owners = cuts[order], owners[order]
    first = np.searchsorted(owners, np.arange(n))
    lines = T.lowered(T.Texts(0, len(cuts), texts.data, np.concatenate([cuts, [len(texts.data)]])))
    return lines, T.split_words(lines), owners, np.arange(len(cuts)) - first[owners]


class _Sequences:
    """Hashes of stretches of words from running sums, alike wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = T._power_table(len(hashes) + 1)
        self.up = up
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return T.mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))

    def without(self, starts: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The stretch's hash with the word at one place left out."""
        tail = self.raw(places + 1, ends) * self.up[places - starts]
        return T.mix(self.raw(starts, places) + tail + (ends - starts - 1).astype(np.uint64))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        rows = batch.column(1).to_numpy(zero_copy_only=False)
        for texts in T.slices(batch.column(2)):
            lines, words, owners, numbers = _lines(texts)
            held = np.flatnonzero(words.counts)
            hashes = T.word_hashes(lines, words)
            starts, ends, n = words.first[:-1][held], words.first[1:][held], words.counts[held]
            sequences = _Sequences(hashes)
            h1 = sequences.of(starts, ends)
            h2 = _Sequences(T.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))).of(starts, ends)
            halves = []
            for shorter in (n, n - 1):
                middle = shorter // 2
                for side, (a, b) in enumerate(((starts, starts + middle), (ends - (shorter - middle), ends))):
                    salt = T.mix((shorter * 2 + side).astype(np.uint64))
                    halves.append(sequences.of(a, b) ^ salt)
            table = np.stack(halves, axis=1).view(np.int64)
            long_enough = n >= LEAST_WORDS
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(np.where(long_enough, 4, 0))]).astype(np.int32),
                pa.array(table[long_enough].ravel()),
            )
            at = owners[held] + texts.low
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs[at]), pa.array(rows[at]), pa.array(numbers[held].astype(np.int32)),
                    pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), lists,
                ],
                names=["doc", "row", "line", "h1", "h2", "halves"],
            )


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each text, as their words with single spaces."""
    for batch in batches:
        out = []
        for doc, row, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = (text or b"").split(b"\n")
            out += [(doc, row, i, b" ".join(lines[i].lower().split())) for i in set(wanted)]
        columns = zip(*out, strict=True) if out else [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc", "row", "line", "words"]
        )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in T.slices(batch.column(3), 1 << 18):
            words = T.split_words(texts)
            sequences = _Sequences(T.word_hashes(texts, words))
            n = words.counts
            at = words.text_of()
            places = np.arange(len(words.starts))
            shorter = sequences.without(words.first[:-1][at], words.first[1:][at], places)
            whole = sequences.of(words.first[:-1], words.first[1:])
            lines = np.concatenate([np.arange(len(n)), at]) + texts.low
            left_out = np.concatenate([np.full(len(n), -1), places - words.first[:-1][at]])
            columns = [batch.column(i).take(pa.array(lines)) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([whole, shorter]).view(np.int64)),
                    pa.array(left_out.astype(np.int32)), *columns,
                ],
                names=["variant", "left_out", "doc", "row", "line"],
            )


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
        kept = [within_one_edit(a.split(), b.split()) for a, b in pairs]
        yield batch.select([0, 1, 2]).filter(pa.array(kept, pa.bool_()))


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each line with words, and whether it goes: ``doc, row, line, goes``."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("row"),
        F.col(text).cast("binary").alias("text"),
    )
    place = F.struct("doc", "row", "line")
    lines = materialise(rows.mapInArrow(_measure, LINES), "lines")
    distinct = materialise(
        lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.first("halves").alias("halves")), "distinct_lines"
    )
    keys = distinct.select("first", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    alike = keys.join(shared, "half").select("first.*").distinct()
    wanted = alike.groupBy("doc", "row").agg(F.collect_set("line").alias("wanted"))
    found = rows.join(wanted, ["doc", "row"]).select("doc", "row", "text", "wanted")
    worded = materialise(found.mapInArrow(_words_of, WORDED).distinct(), "alike_lines")
    variants = worded.mapInArrow(_variants, VARIANTS)
    counted = variants.groupBy("variant").agg(F.count("*").alias("n"), F.min("left_out").alias("_any"))
    common = materialise(counted.where("n > 1").select("variant"), "common_variants")
    variants = materialise(variants.join(common, "variant"), "variants")
    whole, cut = variants.where("left_out < 0"), variants.where("left_out >= 0")
    alike_cut = cut.groupBy("variant", "left_out").agg(F.min(place).alias("earlier"))
    longer = cut.groupBy("variant").agg(F.min(place).alias("earlier"))
    shorter = whole.groupBy("variant").agg(F.min(place).alias("earlier"))
    pairs = (
        cut.join(alike_cut, ["variant", "left_out"]).select(place.alias("own"), "earlier")
        .unionByName(whole.join(longer, "variant").select(place.alias("own"), "earlier"))
        .unionByName(cut.join(shorter, "variant").select(place.alias("own"), "earlier"))
        .where("earlier < own").distinct()
    )
    words = worded.select(place.alias("place"), "words")
    both = (
        pairs.join(words.select(F.col("place").alias("own"), F.col("words").alias("a")), "own")
        .join(words.select(F.col("place").alias("earlier"), F.col("words").alias("b")), "earlier")
        .select("own.*", "a", "b")
    )
    edited = both.mapInArrow(_verify, "doc long, row long, line int").distinct()
    near = distinct.join(edited.select(place.alias("first")), "first", "left_semi").select("h1", "h2")
    judged = lines.join(distinct.select("h1", "h2", "first"), ["h1", "h2"])
    judged = judged.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    goes = (place != F.col("first")) | F.coalesce("near", F.lit(False))
    return judged.select("doc", "row", "line", goes.alias("goes"))


def _with_removed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All columns of ``docs`` and ``_removed``, the numbers of the lines to go."""
    marked = _marked(docs, key, text).where("goes").distinct()
    gone = marked.groupBy("doc", "row").agg(F.array_sort(F.collect_list("line")).alias("_removed"))
    gone = gone.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "_removed")
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    same = (doc == F.col("_doc")) & (F.xxhash64(text) == F.col("_row"))
    nothing = F.array().cast("array<int>")
    return docs.join(gone, same, "left").select(
        *[F.col(c) for c in docs.columns], F.coalesce("_removed", nothing).alias("_removed")
    )


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_lines, n_removed, removed`` for each row, ``removed`` the line numbers from 0."""
    breaks = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\n]+", ""))
    small = docs.select(key, F.xxhash64(text).alias("_hash"), (breaks + 1).cast("long").alias("n_lines"))
    marked = _marked(docs, key, text).where("goes").distinct()
    gone = marked.groupBy("doc", "row").agg(F.array_sort(F.collect_list("line")).alias("_removed"))
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    removed = F.coalesce("_removed", F.array().cast("array<int>"))
    return small.join(gone, (doc == F.col("doc")) & (F.col("_hash") == F.col("row")), "left").select(
        key, "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated lines gone from its texts."""
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(lines, lambda _, i: ~F.array_contains(F.col("_removed"), i))
    kept = F.when(F.size("_removed") == 0, F.col(text)).otherwise(F.array_join(left, "\n"))
    return _with_removed(docs, key, text).select(
        *[kept.alias(c) if c == text else F.col(c) for c in docs.columns]
    )
