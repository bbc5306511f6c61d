"""Removing repeated byte strings by a distributed merge sort of suffixes.

Every byte goes that a string of ``LENGTH`` bytes covers which also starts anywhere
else, in the same text or another. Texts are UTF-8 bytes; matches stay inside a
text; strings are judged on the input. The result is exact but for collisions of
64-bit hashes.

1. Anchors. In each string of ``LENGTH`` bytes the place whose ``GRAM`` bytes hash
   lowest is an anchor, so equal strings have an anchor at the same place. Only
   anchors whose gram other anchors share can lie in a repeated string.
2. Merge sort. For each such anchor the text from it on, and the text before it
   read backwards, are suffixes to sort. A map task sorts its own, front-codes them
   (length shared with the one before, then the rest) and cuts the run at sampled
   splitters. A shard merges its runs with a loser tree that keeps for each head
   how much it shares with the last string put out, and so compares bytes only
   beyond a prefix known to be equal. The prefix shared with a neighbour bounds how
   far a repeat can reach from the anchor to either side. Equal strings of a task
   travel once.
3. Spans. What those bounds leave are spans of places where repeated strings may
   start. Equal spans are counted by hash: one that occurs twice is repeated whole.
   All others have their strings looked up among the strings of all spans, each
   distinct span once, by sorted packed hashes sharded by hash range.

Copies of a whole text are one text with a count throughout.

Null or empty texts have nothing to remove. Rows with equal keys and texts are
copies like any other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

LENGTH = 400
GRAM = 32
# Suffixes of one shard, strings of one shard, about.
SHARD_SUFFIXES = 50_000
SHARD_KEYS = 1 << 20
SAMPLES = 16
SLICE = 4 << 20

ANCHORS = "h binary, places array<int>, keys array<long>"
RUN = "shard int, shared binary, rests binary, lengths binary, owners binary, places binary, counts binary"
REACH = "h binary, place int, forward boolean, reach int"
SPANS = "h binary, low int, high int, s1 long, s2 long, copies long"


def _sliding(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` values in a row."""
    n = len(values)
    size = -(-n // width) * width
    fill = np.iinfo(values.dtype).max if op is np.minimum else 0
    padded = np.concatenate([values, np.full(size - n, fill, dtype=values.dtype)]).reshape(-1, width)
    ahead = op.accumulate(padded, axis=1).ravel()
    back = op.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], ahead[width - 1 : n])


def anchors(grams: np.ndarray) -> np.ndarray:
    """Places whose gram hashes lowest in some string of ``LENGTH`` bytes."""
    width = LENGTH - GRAM + 1
    least = _sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == grams)


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in T.slices(batch.column(1), 1 << 20):
            sums = texts.prefix_hashes()
            names, places, keys = [], [], []
            for i in range(texts.high - texts.low):
                low, high = int(texts.offsets[i]), int(texts.offsets[i + 1])
                if high - low < LENGTH:
                    continue
                at = np.arange(low, high - GRAM + 1)
                grams = T.span_hashes(sums, at, at + GRAM)
                own = anchors(grams)
                names.append(batch.column(0)[texts.low + i].as_py())
                places.append(own.astype(np.int32))
                keys.append(grams[own].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(places, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
                names=["h", "places", "keys"],
            )


def _suffixes(h: bytes, text: bytes, places: list[int], keys: list[int]) -> Iterator[tuple[bytes, int]]:
    """Each anchor's text onwards and backwards, behind its side and gram; even and odd places."""
    for place, key in zip(places, keys, strict=True):
        name = (key & (1 << 64) - 1).to_bytes(8, "big")
        yield b"\0" + name + text[place : place + LENGTH], place * 2
        yield b"\1" + name + text[max(0, place - LENGTH + GRAM) : place][::-1], place * 2 + 1


HEAD = 9


def _sampled(every: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h, text, places, keys = row
                picked = [i for i, p in enumerate(places) if zlib.crc32(h + p.to_bytes(4, "big")) % every == 0]
                chosen += [s for s, _ in _suffixes(h, text, [places[i] for i in picked], [keys[i] for i in picked])]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary())], names=["suffix"])

    return sample


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the prefix that two strings share, from a length known to be shared."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Of sorted strings, what each shares with the one before, and the rests."""
    shared = np.zeros(len(strings), dtype="<u2")
    for i in range(1, len(strings)):
        shared[i] = common_prefix(strings[i - 1], strings[i])
    return shared, [s[k:] for s, k in zip(strings, shared.tolist(), strict=True)]


def _runs(sent):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = sent.value
        held: list[tuple[bytes, bytes, int]] = []
        size = 0

        def runs():
            held.sort(key=lambda e: e[0])
            at = 0
            rows = []
            while at < len(held):
                shard = bisect_right(splitters, held[at][0])
                strings, counts, owners, places = [], [], [], []
                while at < len(held) and (shard == len(splitters) or held[at][0] < splitters[shard]):
                    string, h, place = held[at]
                    if strings and strings[-1] == string:
                        counts[-1] += 1
                    else:
                        strings.append(string)
                        counts.append(1)
                    owners.append(h)
                    places.append(place)
                    at += 1
                shared, rests = front_coded(strings)
                lengths = np.array([len(r) for r in rests], dtype="<u2")
                rows.append(
                    (shard, shared.tobytes(), b"".join(rests), lengths.tobytes(), b"".join(owners),
                     np.array(places, "<u4").tobytes(), np.array(counts, "<u4").tobytes())
                )
            columns = zip(*rows, strict=True)
            kinds = [pa.int32()] + [pa.binary()] * 6
            names = [f.split()[0] for f in RUN.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for h, text, own, keys, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for string, place in _suffixes(h, text, own, keys):
                    # A text that has copies meets itself, so its suffixes come twice.
                    held += [(string, h, place)] * min(copies, 2)
                    size += len(string) + 100
                if size > 64 << 20:
                    yield runs()
                    held, size = [], 0
        if held:
            yield runs()

    return cut


class _Run:
    """A front-coded run, decoded one string at a time."""

    def __init__(self, shared: bytes, rests: bytes, lengths: bytes):
        self.shared = np.frombuffer(shared, "<u2").tolist()
        self.lengths = np.frombuffer(lengths, "<u2").tolist()
        self.rests, self.at, self.begin, self.string = rests, -1, 0, b""
        self.advance()

    def advance(self) -> int:
        """Go to the next string; what it shares with the one before."""
        self.at += 1
        if self.at == len(self.shared):
            self.string = None
            return 0
        keep, end = self.shared[self.at], self.begin + self.lengths[self.at]
        self.string = self.string[:keep] + self.rests[self.begin : end]
        self.begin = end
        return keep


def merged(runs: list[_Run]) -> Iterator[tuple[int, int, int, int]]:
    """The runs' strings in order: run, number in it, length, and prefix shared with the one before.

    A loser tree: each inner node keeps the loser of its match and the prefix it
    shares with that match's winner. The next string of the winner's run and the
    losers on its way up all know what they share with the string just put out;
    the one that shares more is the smaller, and only if both share the same are
    bytes compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    shared = [0] * k
    losers = [-1] * k

    def better(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        x = runs[a].string if a < len(runs) else None
        y = runs[b].string if b < len(runs) else None
        if x is None:
            return b, a
        if y is None:
            return a, b
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = common_prefix(x, y, shared[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = better(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while winner < len(runs) and runs[winner].string is not None:
        run = runs[winner]
        yield winner, run.at, len(run.string), shared[winner]
        shared[winner] = run.advance()
        node = (winner + k) // 2
        while node:
            winner, losers[node] = better(winner, losers[node])
            node //= 2


def _merge(table: pa.Table) -> pa.Table:
    """How far each suffix of a shard agrees with its nearest neighbour.

    The first and last string of a shard have a neighbour elsewhere, so they count
    as agreeing all along; the look-up of strings decides there.
    """
    rows = [tuple(c[i].as_py() for c in table.columns) for i in range(table.num_rows)]
    runs = [_Run(r[1], r[2], r[3]) for r in rows]
    counts = [np.frombuffer(r[6], "<u4") for r in rows]
    reach = [np.zeros(len(c), dtype=np.int64) for c in counts]
    before = None
    for run, number, length, shared in merged(runs):
        own = length if counts[run][number] > 1 or before is None else shared
        reach[run][number] = own
        if before is not None:
            last, at = before
            reach[last][at] = max(reach[last][at], shared)
        before = run, number
    if before is not None:
        reach[before[0]][before[1]] = HEAD + LENGTH
    owners, places, reaches = [], [], []
    for row, own, n in zip(rows, reach, counts, strict=True):
        held = np.maximum(np.repeat(own, n) - HEAD, 0)
        useful = held > 0
        names = np.frombuffer(row[4], dtype="V16")[useful]
        owners += [x.tobytes() for x in names]
        places.append(np.frombuffer(row[5], "<u4")[useful])
        reaches.append(held[useful])
    places, reaches = np.concatenate(places), np.concatenate(reaches)
    return pa.table(
        {
            "h": pa.array(owners, pa.binary()), "place": pa.array((places // 2).astype(np.int32)),
            "forward": pa.array(places % 2 == 0), "reach": pa.array(reaches.astype(np.int32)),
        }
    )


def _span_hashes(text: bytes, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums = T.Texts(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)])).prefix_hashes()
    low, high = (np.array(x, dtype=np.int64) for x in zip(*spans, strict=True))
    s1 = T.span_hashes(sums, low, high + LENGTH)
    s2 = [int.from_bytes(hashlib.blake2b(text[a : b + LENGTH], digest_size=8).digest(), "little", signed=True) for a, b in spans]
    return sums, s1, np.array(s2, dtype=np.int64)


def _make_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places where repeated strings may start, from what the merge left possible."""
    for batch in batches:
        out = []
        for h, text, copies, reaches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n = len(text) - LENGTH + 1
            edges = np.zeros(n + 1, dtype=np.int64)
            if copies > 1:
                edges[0] += 1
            by_place: dict[int, list[int]] = {}
            for r in reaches:
                both = by_place.setdefault(r["place"], [0, 0])
                both[not r["forward"]] = max(both[not r["forward"]], r["reach"])
            for place, (ahead, back) in by_place.items():
                low = max(place - min(back, LENGTH - GRAM), 0)
                high = min(place - max(LENGTH - ahead, 0), n - 1)
                if low <= high:
                    edges[low] += 1
                    edges[high + 1] -= 1
            open_ = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
            turns = np.flatnonzero(open_[1:] != open_[:-1])
            spans = list(zip(turns[::2].tolist(), (turns[1::2] - 1).tolist(), strict=True))
            if spans:
                _, s1, s2 = _span_hashes(text, spans)
                out += [
                    (h, a, b, x, y, copies)
                    for (a, b), x, y in zip(spans, s1.view(np.int64).tolist(), s2.tolist(), strict=True)
                ]
        columns = zip(*out, strict=True) if out else [()] * 6
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["h", "low", "high", "s1", "s2", "copies"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


CHUNKED = "chunk long, keys binary, twice binary, s1 array<long>, s2 array<long>, lengths array<long>, codes binary, n_keys long"


def _chunk_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct strings of a chunk of spans: sorted hashes, whether known to occur twice,
    and for the spans still open the numbers of their strings."""
    made, held, size = 0, [], 0

    def chunk():
        keys = np.concatenate([k for k, _, _, _ in held])
        sure = np.concatenate([np.full(len(k), n > 1) for k, n, _, _ in held])
        distinct, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts > 1
        np.logical_or.at(twice, at[sure], True)
        unsettled = np.concatenate([np.full(len(k), n == 1) for k, n, _, _ in held])
        spans = [(s1, s2, len(k)) for k, n, s1, s2 in held if n == 1]
        return pa.RecordBatch.from_pydict(
            {
                "chunk": [(TaskContext.get().partitionId() << 32) + made],
                "keys": [distinct.tobytes()], "twice": [np.packbits(twice).tobytes()],
                "s1": [[s[0] for s in spans]], "s2": [[s[1] for s in spans]], "lengths": [[s[2] for s in spans]],
                "codes": [zlib.compress(at[unsettled].astype("<u4").tobytes(), 1)], "n_keys": [len(distinct)],
            },
            schema=_CHUNKED,
        )

    for batch in batches:
        for text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums = T.Texts(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)])).prefix_hashes()
            for s in spans:
                at = np.arange(s["low"], s["high"] + 1)
                held.append((T.span_hashes(sums, at, at + LENGTH), s["n"], s["s1"], s["s2"]))
                size += len(at)
            if size > SHARD_KEYS:
                yield chunk()
                made, held, size = made + 1, [], 0
    if held:
        yield chunk()


_CHUNKED = pa.schema(
    [
        ("chunk", pa.int64()), ("keys", pa.binary()), ("twice", pa.binary()), ("s1", pa.list_(pa.int64())),
        ("s2", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary()), ("n_keys", pa.int64()),
    ]
)


def _deal(bits: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
        for batch in batches:
            for chunk, keys, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = np.frombuffer(keys, "<u8")
                flags = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(held))
                cuts = np.concatenate([[0], np.searchsorted(held, bounds), [len(held)]])
                rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(rows), pa.int64()), pa.array([s for s, _, _ in rows], pa.int32()),
                        pa.array([held[a:b].tobytes() for _, a, b in rows], pa.binary()),
                        pa.array([flags[a:b].tobytes() for _, a, b in rows], pa.binary()),
                    ],
                    names=["chunk", "shard", "keys", "twice"],
                )

    return deal


def _answer(table: pa.Table) -> pa.Table:
    """For each chunk of a shard, which of its strings occur twice or more over all chunks."""
    keys = [np.frombuffer(k, "<u8") for k in table.column("keys").to_pylist()]
    sure = np.frombuffer(b"".join(table.column("twice").to_pylist()), np.uint8)
    _, at, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    twice = counts > 1
    np.logical_or.at(twice, at[sure > 0], True)
    answers = np.split(twice[at], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table(
        {
            "chunk": table.column("chunk"), "shard": table.column("shard"),
            "n": pa.array([len(a) for a in answers], pa.int64()),
            "twice": pa.array([np.packbits(a).tobytes() for a in answers], pa.binary()),
        }
    )


def _settle(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """The stretches of each open span whose strings occur twice."""
    out = []
    for row in chunk.to_pylist():
        parts = sorted(answers.to_pylist(), key=lambda a: a["shard"])
        twice = np.concatenate([np.unpackbits(np.frombuffer(a["twice"], np.uint8), count=a["n"]) for a in parts])
        found = twice[np.frombuffer(zlib.decompress(row["codes"]), "<u4")] > 0
        begin = 0
        for s1, s2, length in zip(row["s1"], row["s2"], row["lengths"], strict=True):
            held = np.concatenate([[False], found[begin : begin + length], [False]])
            begin += length
            turns = np.flatnonzero(held[1:] != held[:-1]).tolist()
            out += [(s1, s2, a, b - 1) for a, b in zip(turns[::2], turns[1::2], strict=True)]
    columns = zip(*out, strict=True) if out else [()] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("s1", "s2", "first", "last"), columns, strict=True)})


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for h, text, stretches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            edges = np.zeros(len(text) + 1, dtype=np.int64)
            for s in stretches:
                edges[s["first"]] += 1
                edges[s["last"] + LENGTH] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)) == 1)
            left = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((h, int(gone.sum()), len(turns), hashlib.sha256(left).hexdigest(), left))
        columns = zip(*out, strict=True) if out else [()] * 5
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["h", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _cut_texts(rows: DataFrame) -> DataFrame:
    """``h, n_removed, n_spans, kept_sha256, kept`` of the texts that lose bytes; ``rows`` has ``h, text``."""
    spark = rows.sparkSession
    found = rows.mapInArrow(_find_anchors, ANCHORS)
    texts = materialise(
        found.groupBy("h").agg(
            F.first("places").alias("places"), F.first("keys").alias("keys"), F.count("*").alias("copies")
        ),
        "anchors",
    )
    each = texts.select("h", "copies", F.inline(F.arrays_zip("places", "keys")))
    shared = each.groupBy("keys").agg(F.sum("copies").alias("n")).where("n > 1").select("keys")
    # Written first, so that both sides of the join come from a shuffle and a hot gram is split.
    shared = materialise(shared, "shared_grams")
    wanted = each.join(shared, "keys").groupBy("h").agg(
        F.collect_list("places").alias("places"), F.collect_list("keys").alias("keys"), F.first("copies").alias("copies")
    )
    held = rows.join(wanted, "h").dropDuplicates(["h"]).select("h", "text", "places", "keys", "copies")
    held = materialise(held, "suffix_texts")
    n = (held.agg(F.sum(F.size("places"))).first()[0] or 0) * 2
    every = max(1, SHARD_SUFFIXES // SAMPLES)
    sample = held.select("h", "text", "places", "keys").mapInArrow(_sampled(every), "suffix binary")
    # One sampled suffix in ``every``, and one splitter for each shard.
    sampled = sorted(bytes(r.suffix) for r in sample.collect()) if n > SHARD_SUFFIXES else []
    splitters = sorted(set(sampled[SAMPLES::SAMPLES]))
    sent = spark.sparkContext.broadcast(splitters)
    runs = held.mapInArrow(_runs(sent), RUN)
    reach = materialise(runs.groupBy("shard").applyInArrow(_merge, REACH), "reaches")
    grouped = reach.groupBy("h").agg(F.collect_list(F.struct("place", "forward", "reach")).alias("reaches"))
    # Only texts whose suffixes reached a neighbour, or that have copies, can have spans.
    joined = held.select("h", "text", "copies").join(grouped, "h", "left")
    nothing = F.array().cast("array<struct<place:int,forward:boolean,reach:int>>")
    spans = joined.select("h", "text", "copies", F.coalesce("reaches", nothing).alias("reaches"))
    spans = materialise(spans.mapInArrow(_make_spans, SPANS), "spans")
    one = F.min(F.struct("h", "low", "high")).alias("one")
    distinct = materialise(spans.groupBy("s1", "s2").agg(F.sum("copies").alias("n"), one), "distinct_spans")
    chosen = distinct.groupBy("one.h").agg(
        F.collect_list(F.struct("one.low", "one.high", F.least("n", F.lit(2)).cast("int").alias("n"), "s1", "s2")).alias("spans")
    )
    asked = held.select("h", "text").join(chosen, "h").select("text", "spans")
    chunks = materialise(asked.mapInArrow(_chunk_strings, CHUNKED), "string_chunks")
    keys = chunks.agg(F.sum("n_keys")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(keys, 1) / SHARD_KEYS))))
    dealt = chunks.select("chunk", "keys", "twice").mapInArrow(_deal(bits), "chunk long, shard int, keys binary, twice binary")
    answers = dealt.groupBy("shard").applyInArrow(_answer, "chunk long, shard int, n long, twice binary")
    questions = chunks.select("chunk", "s1", "s2", "lengths", "codes")
    settled = questions.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _settle, "s1 long, s2 long, first long, last long"
    )
    whole = distinct.where("n > 1").select(
        "s1", "s2", F.lit(0).cast("long").alias("first"), F.expr("cast(one.high - one.low as bigint)").alias("last")
    )
    repeated = whole.unionByName(settled)
    stretches = spans.join(repeated, ["s1", "s2"]).groupBy("h").agg(
        F.collect_list(F.struct((F.col("low") + F.col("first")).alias("first"), (F.col("low") + F.col("last")).alias("last"))).alias("stretches")
    )
    cut = held.select("h", "text").join(stretches, "h").mapInArrow(
        _remove, "h binary, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return cut


def removed_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for each row."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    name = F.unhex(F.md5(body))
    rows = docs.where(F.octet_length(text) >= LENGTH).select(name.alias("h"), body.alias("text"))
    cut = materialise(_cut_texts(rows).drop("kept"), "cut_texts")
    plain = docs.select(
        F.col(key), name.alias("h"), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("sha")
    )
    none = F.lit(0).cast("long")
    return plain.join(cut, "h", "left").select(
        key, "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``kept``, the bytes left of each text."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    name = F.unhex(F.md5(body))
    rows = docs.where(F.octet_length(text) >= LENGTH).select(name.alias("h"), body.alias("text"))
    cut = materialise(_cut_texts(rows).select(F.col("h").alias("_h"), F.col("kept").alias("_kept")), "cut_texts")
    return docs.join(cut, name == F.col("_h"), "left").select(
        *[F.col(c) for c in docs.columns], F.coalesce("_kept", body).alias("kept")
    )
