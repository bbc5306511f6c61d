"""Spelling variants: words one edit apart, found by a bidirectional FM-index.

Words are runs of Latin letters, ``A-Z`` in lower case. Two words are near if one
inserted, deleted or replaced character turns one into the other.

If one edit turns a word into another, one half of the word stands in the other as it
is, at its end of it. So each word asks twice: with its left half, and with its right
one. Words that share a half, and are at most one longer or shorter, form a group; the
group of a half is an index of the words that can answer. A group of more than
``GROUP`` words is split by the same argument: of the half that is still open, one
half again is as it is. Where a single character is left open, the group is no larger
than the alphabet allows. So no group grows with the number of words, and no pair of
near words is lost.

A task lays its groups' words out as ``#word#word#...#`` and builds an index of that
text and of its mirror image. A pattern is an interval of suffix ranks in either; it
can be extended to the left or to the right, and both intervals follow. A query
matches its exact part from the inside out to the delimiter, then extends over the
open part, where at each place one character may be put in, left out or exchanged,
then over what is left, to the other delimiter. What it arrives at is a near word.

A word's form is its most frequent near word, if that is at least twice as frequent;
equal ones go by code points. Forms are followed to the root by doubling: as a form is
twice as frequent, a chain is no longer than the logarithm of the largest count.

Null and empty texts have no words. Repeated rows count each. A null ``doc_id`` counts as
the empty text where keys decide. Other columns are ignored; an empty table gives no
rows. Words of any length are taken whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.text import LOWER, Texts, slices, span_hashes, split_words
from opinara.session import materialise

# The characters of a word are A-Z, a-z and U+00C0 to U+00FF, which in
# UTF-8 are those of two bytes that begin with this one; and which occurrences lose one.
TWO_BYTES = 0xC3
LOSES_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

# Words of a group above which it is split.
GROUP = 20_000
# Letters indexed at a time, more if one group has more.
CHUNK_LETTERS = 1 << 18
# Query states followed at a time.
STATES = 1 << 16

END, DELIMITER = 0, 1
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
# Bytes of text whose words are counted at a time; a longer text is taken alone, whole.
COUNTED_BYTES = 2 << 20
STEP = 32  # symbols between the counts an index keeps


def _letters_only(texts: Texts) -> Texts:
    """Everything between the runs as spaces, and ``A-Z`` in lower case."""
    data = texts.data
    letter = _ASCII_LETTER[data] | (data == TWO_BYTES)
    letter[1:] |= data[:-1] == TWO_BYTES
    return Texts(texts.low, texts.high, np.where(letter, LOWER[data], 32).astype(np.uint8), texts.offsets)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes, carried on from the CRC-32 of what is before it."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    state = (before ^ np.uint32(0xFFFFFFFF))[order]
    at = starts[order]
    # The spans longer than each place are the first so many.
    longer = len(order) - np.cumsum(np.bincount(lengths, minlength=1))
    for place in range(int(lengths.max(initial=0))):
        n = longer[place]
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + place]) & 255] ^ (state[:n] >> np.uint32(8))
    checks = np.empty(len(order), dtype=np.uint32)
    checks[order] = state ^ np.uint32(0xFFFFFFFF)
    return checks


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as binary values."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    gathered = data[np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], ends - starts)]
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(gathered)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).cast(pa.binary())


def _counted(texts: Texts, keys: list[str], least_length: int) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts and their counts; a word comes up to twice."""
    texts = _letters_only(texts)
    words = split_words(texts)
    leads = np.concatenate([[0], np.cumsum(texts.data == TWO_BYTES)])
    starts, ends, owner = words.starts, words.ends, words.text_of()
    length = ends - starts - (leads[ends] - leads[starts])
    long_ = np.flatnonzero(length >= least_length)
    starts, ends, owner, length = starts[long_], ends[long_], owner[long_], length[long_]
    prefixes = np.array([zlib.crc32(f"{key}:".encode()) for key in keys], dtype=np.uint32)
    checks = _checks(texts.data, starts, ends, prefixes[owner])
    loses = checks % LOSES_EVERY == 0
    whole = np.flatnonzero(~loses)
    hashes = span_hashes(texts.prefix_hashes(), starts[whole], ends[whole])
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    shortened = []
    for i in np.flatnonzero(loses & (length > least_length)):
        run = texts.data[starts[i] : ends[i]].tobytes().decode()
        at = int(checks[i]) % len(run)
        shortened.append((run[:at] + run[at + 1 :]).encode())
    found = [_spans(texts.data, starts[whole][first], ends[whole][first]), pa.array(shortened, pa.binary())]
    return pa.concat_arrays(found), np.concatenate([counts, np.ones(len(shortened), dtype=np.int64)])


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words of ``docs`` (``doc_id, text``), some having lost a character.

    A task counts within some texts at a time; a run of the least length or less gets
    no longer by losing a character, so it is left out first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for texts in slices(batch.column("text"), COUNTED_BYTES):
                found, counts = _counted(texts, keys[texts.low : texts.high], least_length)
                yield pa.record_batch([found, pa.array(counts)], ["word", "n"])

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    counted = keyed.mapInArrow(count, "word binary, n long")
    summed = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    return summed.select(F.col("word").cast("string").alias("word"), "n")


def _keyed(rows: DataFrame) -> DataFrame:
    """The group of each row: its word as it would answer queries of length ``m`` with ``[a, b)`` open."""
    end = F.col("m") - F.col("b")
    length = F.char_length("word")
    left = F.substring("word", F.lit(1), F.col("a"))
    right = F.substring("word", length - end + 1, end)
    return rows.withColumn("key", F.xxhash64("m", "a", "b", left, right))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice, with either half of what is open."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    parts = F.array(
        F.struct(middle.alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), middle.alias("b"))
    )
    split = rows.withColumn("_part", F.explode(parts))
    return _keyed(split.withColumns({"a": F.col("_part.a"), "b": F.col("_part.b")}).drop("_part"))


def groups(vocabulary: DataFrame, largest: int = GROUP) -> DataFrame:
    """``key, word, n, m, a, b``: the groups each word is in; it asks where ``m`` is its length."""
    length = F.char_length("word")
    lengths = F.array(length - 1, length, length + 1)
    whole = vocabulary.select("word", "n", F.explode(lengths).alias("m"))
    pending = _halves(whole.withColumns({"a": F.lit(0), "b": F.col("m")}))
    settled = None
    while True:
        counted = pending.where("b - a > 1").groupBy("key").agg(F.count("*").alias("rows"))
        # At most one for each `largest` rows.
        large = materialise(counted.where(F.col("rows") > largest).select("key"), "large_groups")
        done = large.isEmpty()
        small = pending if done else pending.join(large, "key", "left_anti")
        # Nothing is left to split where one character is open.
        narrow = None if done else pending.where("b - a <= 1").join(large, "key", "left_semi")
        for part in (small, narrow):
            if part is not None:
                settled = part if settled is None else settled.unionByName(part)
        if done:
            return settled
        pending = _halves(pending.where("b - a > 1").join(large, "key", "left_semi").drop("key"))


# The index


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of the suffixes in order, by doubling from eight symbols on; symbols have seven bits."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(8, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(8):
        key = (key << 7) | padded[i : i + n]
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.ones(n, dtype=np.int64)
        new[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n:
            return order
        behind = np.zeros(n, dtype=np.int64)
        behind[: max(n - width, 0)] = rank[width:]
        key = rank * (n + 1) + behind
        width *= 2


class _Ranks:
    """A transformed text with the counts of its symbols before any place."""

    def __init__(self, text: np.ndarray, suffixes: np.ndarray, symbols: int) -> None:
        n = len(text)
        self.before = text[suffixes - 1]
        steps = n // STEP + 2
        padded = np.full(steps * STEP, 255, dtype=np.uint8)
        padded[:n] = self.before
        self.blocks = padded.reshape(steps, STEP)
        cells = np.repeat(np.arange(steps), STEP)[:n] * symbols + self.before
        held = np.bincount(cells, minlength=steps * symbols).reshape(steps, symbols)
        upto = np.zeros((steps + 1, symbols + 1), dtype=np.int32)
        upto[1:, 1:] = np.cumsum(np.cumsum(held, axis=0), axis=1)
        self.upto = upto  # [block, c]: symbols below c before the block
        self.first = upto[-1]
        self._offsets = np.arange(STEP, dtype=np.int64)

    def counts(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many symbols before ``at`` are below ``symbol``, and how many are it."""
        block = at // STEP
        held = self.blocks[block]
        inside = self._offsets[None, :] < (at % STEP)[:, None]
        wanted = symbol.astype(np.uint8)[:, None]
        below = self.upto[block, symbol].astype(np.int64)
        same = self.upto[block, symbol + 1] - below
        return below + (inside & (held < wanted)).sum(axis=1), same + (inside & (held == wanted)).sum(axis=1)


@dataclass
class States:
    """Intervals of suffix ranks, in the text read on and in its mirror image."""

    query: np.ndarray
    low: np.ndarray
    mirror: np.ndarray
    size: np.ndarray

    def take(self, which: np.ndarray) -> States:
        return States(self.query[which], self.low[which], self.mirror[which], self.size[which])


class BidirectionalIndex:
    """The words as ``#word#word#``, searchable towards either side."""

    def __init__(self, letters: np.ndarray, starts: np.ndarray) -> None:
        """``letters``: all words' characters, up to 255; ``starts``: each word's first, and the end."""
        present = np.unique(letters)
        self.symbol = np.zeros(256, dtype=np.uint8)
        self.symbol[present] = np.arange(2, len(present) + 2)
        self.symbols = len(present) + 2
        n_words = len(starts) - 1
        n = len(letters) + n_words + 1
        text = np.full(n, DELIMITER, dtype=np.uint8)
        word_of = np.repeat(np.arange(n_words), np.diff(starts))
        text[np.arange(len(letters)) + word_of + 1] = self.symbol[letters]
        self.delimiters = starts[:-1] + np.arange(n_words)
        end = np.zeros(1, dtype=np.uint8)
        forward, backward = np.concatenate([text, end]), np.concatenate([text[::-1], end])
        self.suffixes = suffix_array(forward)
        self.length = n
        self.left = _Ranks(forward, self.suffixes, self.symbols)
        self.mirror_suffixes = suffix_array(backward)
        self.right = _Ranks(backward, self.mirror_suffixes, self.symbols)

    def whole(self, query: np.ndarray) -> States:
        zeros = np.zeros(len(query), dtype=np.int64)
        return States(query, zeros, zeros, np.full(len(query), self.length + 1, dtype=np.int64))

    def extend(self, states: States, symbol: np.ndarray, right: bool) -> States:
        """The intervals with one more symbol at one side; those of size 0 match nothing."""
        ranks = self.right if right else self.left
        own, other = (states.mirror, states.low) if right else (states.low, states.mirror)
        below, same = ranks.counts(symbol, own)
        below_end, same_end = ranks.counts(symbol, own + states.size)
        own = ranks.first[symbol] + same
        other = other + below_end - below
        low, mirror = (other, own) if right else (own, other)
        return States(states.query, low, mirror, same_end - same)

    def next_symbols(self, states: States, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """State and symbol of all extensions that can match, and perhaps of some that cannot."""
        ranks = self.right if right else self.left
        own = states.mirror if right else states.low
        narrow = np.flatnonzero(states.size <= 2 * STEP)
        wide = np.flatnonzero(states.size > 2 * STEP)
        sizes = states.size[narrow]
        before = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(before[-1]) + np.repeat(own[narrow] - before[:-1], sizes)
        seen = np.unique(np.repeat(narrow, sizes) * 256 + ranks.before[at])
        first = np.diff(ranks.upto[own[wide] // STEP], axis=1)
        last = np.diff(ranks.upto[(own + states.size)[wide] // STEP + 1], axis=1)
        row, symbol = np.nonzero(last > first)
        states_, symbols = np.append(seen // 256, wide[row]), np.append(seen % 256, symbol)
        letter = symbols > DELIMITER
        return states_[letter], symbols[letter]

    def word(self, states: States) -> np.ndarray:
        """Which word a state that begins and ends with a delimiter is."""
        return np.searchsorted(self.delimiters, self.suffixes[states.low])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def one_edit(
    index: BidirectionalIndex, letters: np.ndarray, first: np.ndarray, length: np.ndarray,
    low: np.ndarray, high: np.ndarray, right: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Query and word of all words that one edit at ``[low, high)`` of a query makes.

    A query is ``length`` characters of ``letters`` from ``first`` on. With ``right``, what lies
    before ``low`` is matched first, then the rest to the right; else the mirror image.
    """
    queries, words = [], []

    def character(query: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The symbol at a place, counted from the side that is matched first; the delimiter after the last."""
        inside = place < length[query]
        at = first[query] + (place if right else length[query] - 1 - place)
        return np.where(inside, index.symbol[letters[np.where(inside, at, 0)]], DELIMITER)

    begin, end = (low, high) if right else (length - high, length - low)
    states = index.whole(np.arange(len(first)))
    # The exact part, from the inside out, and the delimiter before it.
    place = begin - 1
    while len(states.query):
        here = place[states.query] >= -1
        if not here.any():
            break
        at = np.flatnonzero(here)
        wanted = place[states.query[at]]
        symbol = np.where(wanted >= 0, character(states.query[at], np.maximum(wanted, 0)), DELIMITER)
        moved = index.extend(states.take(at), symbol, not right)
        for name in ("low", "mirror", "size"):
            getattr(states, name)[at] = getattr(moved, name)
        place = place - 1
        states = states.take(np.flatnonzero(states.size > 0))
    # The open part: the edit is still to come in `states`; it is made in `edited`, by place.
    place = begin.copy()
    edited, places = [], []
    while len(states.query):
        now = place[states.query]
        open_ = now < end[states.query]
        row, symbol = index.next_symbols(states, right)
        grown = index.extend(states.take(row), symbol, right)
        there = np.flatnonzero(grown.size > 0)
        grown, row, symbol = grown.take(there), row[there], symbol[there]
        own = character(states.query, now)
        other = np.flatnonzero(symbol != own[row])
        # One put in before this place; of a run of equal characters it is the last.
        edited.append(grown.take(other))
        places.append(now[row[other]])
        exchanged = other[open_[row[other]]]
        edited.append(grown.take(exchanged))
        places.append(now[row[exchanged]] + 1)
        left_out = np.flatnonzero(open_)
        edited.append(states.take(left_out))
        places.append(now[left_out] + 1)
        kept = np.flatnonzero((symbol == own[row]) & open_[row])
        # Unlike the query's next character, the same one put in is found one place on,
        # but not where the open part ends.
        doubled = np.flatnonzero((symbol == own[row]) & ~open_[row])
        edited.append(grown.take(doubled))
        places.append(now[row[doubled]])
        states = grown.take(kept)
        place = place + 1
    merged = States(*(_joined([getattr(e, name) for e in edited]) for name in ("query", "low", "mirror", "size")))
    at = _joined(places)
    while len(merged.query):
        merged = index.extend(merged, character(merged.query, at), right)
        there = np.flatnonzero(merged.size > 0)
        finished = at[there] >= length[merged.query[there]]
        done = there[finished]
        queries.append(merged.query[done])
        words.append(index.word(merged.take(done)))
        on = there[~finished]
        merged, at = merged.take(on), at[on] + 1
    return _joined(queries), _joined(words)


def _latin(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of words of Latin letters, one byte each, and where each word begins."""
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    bounds = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    held = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    # In UTF-8 the characters from U+00C0 to U+00FF are the byte C3 and one 40 below them.
    single = held != TWO_BYTES
    letters = np.where(held >= 0x80, held + 0x40, held).astype(np.uint8)[single]
    ahead = np.concatenate([[0], np.cumsum(single)])
    return letters, ahead[bounds - bounds[0]]


def search_groups(rows: pa.Table) -> pa.Table:
    """``word, near, near_n``: what the queries among ``rows`` find in the other rows' words."""
    words = rows.column("word").combine_chunks().dictionary_encode()
    names, code = words.dictionary, np.asarray(words.indices).astype(np.int64)
    counts = np.zeros(len(names), dtype=np.int64)
    counts[code] = np.asarray(rows.column("n"))
    letters, starts = _latin(names)
    index = BidirectionalIndex(letters, starts)
    length = np.diff(starts)
    m, a, b = (np.asarray(rows.column(name)).astype(np.int64) for name in "mab")
    asks = np.flatnonzero(m == length[code])
    from_left = a[asks] >= m[asks] - b[asks]
    found_x, found_y = [], []
    for right in (True, False):
        mine = asks[from_left == right]
        for start in range(0, len(mine), STATES // 16):
            part = mine[start : start + STATES // 16]
            query, near = one_edit(
                index, letters, starts[code[part]], length[code[part]], a[part], b[part], right
            )
            found_x.append(code[part[query]])
            found_y.append(near)
    x, y = _joined(found_x), _joined(found_y)
    pairs = np.unique(x[x != y] * len(names) + y[x != y])
    x, y = pairs // max(len(names), 1), pairs % max(len(names), 1)
    return pa.table({"word": names.take(pa.array(x)), "near": names.take(pa.array(y)), "near_n": pa.array(counts[y])})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of a task's rows, which come sorted by group, searched some at a time."""
    held: list[pa.Table] = []
    n_letters = 0

    def searched(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(parts)
        keys = np.asarray(rows.column("key"))
        bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        alone = np.repeat(np.diff(bounds) == 1, np.diff(bounds))
        rows = rows.filter(pa.array(~alone))
        if rows.num_rows:
            yield from search_groups(rows).to_batches()

    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = np.asarray(table.column("key"))
        while table.num_rows:
            sizes = np.cumsum(np.asarray(pc.binary_length(table.column("word"))).astype(np.int64))
            if n_letters + sizes[-1] < CHUNK_LETTERS:
                held.append(table)
                n_letters += int(sizes[-1])
                break
            # Up to the first group that begins after the chunk is full.
            full = max(int(np.searchsorted(sizes, CHUNK_LETTERS - n_letters)), 0)
            before = held[-1].column("key")[-1].as_py() if held else None
            starts = np.concatenate([[before is not None and keys[0] != before], keys[1:] != keys[:-1]])
            later = np.flatnonzero(starts & (np.arange(len(keys)) >= full))
            if not len(later):
                held.append(table)
                n_letters += int(sizes[-1])
                break
            cut = int(later[0])
            yield from searched([*held, table.slice(0, cut)])
            held, n_letters = [], 0
            table, keys = table.slice(cut), keys[cut:]
    if held:
        yield from searched(held)


def near_words(vocabulary: DataFrame, largest: int = GROUP) -> DataFrame:
    """``word, near, near_n``: each pair of near words of ``vocabulary`` (``word, n``), both ways, once."""
    rows = groups(vocabulary, largest).repartition("key").sortWithinPartitions("key")
    found = rows.mapInArrow(_search, "word string, near string, near_n long")
    return found.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``), chains having ``longest`` links at most."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(longest, 1)))):
        on = reached.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = reached.join(on, F.col("root") == F.col("_word"), "left")
        reached = materialise(joined.select("word", F.coalesce("_root", "root").alias("root")), "roots")
    return reached


def group_variants(docs: DataFrame, largest: int = GROUP) -> DataFrame:
    """Each word with its form, its root, and the counts they follow from."""
    vocabulary = materialise(word_counts(docs), "vocabulary")
    near = near_words(vocabulary, largest)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best")
    judged = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = vocabulary.join(judged, "word", "left")
    frequent = -F.col("best.n") >= 2 * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, -F.col("best.n")).alias("form_n"),
    )
    formed = materialise(formed, "forms")
    most = formed.agg(F.max("n")).first()[0] or 1
    rooted = roots(formed.where("form IS NOT NULL"), int(math.log2(most)) + 1)
    return formed.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
