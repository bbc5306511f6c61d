"""Quality by perplexity under a modified Kneser-Ney model of trusted texts.

The model is an interpolated word trigram model. Spark counts the trigrams of all
trusted texts of one half (by the key's MD5) and derives lower orders, discounts,
context weights and probabilities by joins and aggregations.

Written in back-off form, a text's log probability is a sum over its n-grams of
one number each: what a known word, pair or triple adds to the estimate of the
order below. Those numbers are cut into shards by ranges of the n-gram's hash. Texts
are taken in chunks, whose distinct n-grams are sent to the shards' tasks and joined
there; partial sums are added up by text. A shard's share of the texts is salted into
groups of about ``GROUP_BYTES``, each with its copy of the shard, so copies grow with the
texts and not with texts times shards. The driver only passes on a bitmap of the known
hashes, two to four bytes for each and ``MOST_SLOTS`` bits at most, so that most n-grams
the model does not have are left where they are; those that pass it are looked up whole.

A text is rejected if its perplexity is above its language's threshold: the
``QUANTILE`` of the trusted texts in the other half, which the model has not seen.
Languages with fewer than ``LEAST_HELD`` of those take the quantile over all.

Words compare in lower case (A-Z). Null or empty texts hold the end alone and are
rejected; a null language is one of its own. Repeated rows are scored one by one.
Without trusted texts nothing can be judged, so that raises. An empty table gives
no rows. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm import text as T
from opinara.session import materialise

QUANTILE = 0.995
LEAST_HELD = 20
SHARD_ENTRIES = 1 << 20
SLICE = 1 << 20
GROUP_BYTES = 1 << 27
MOST_SLOTS = 1 << 28
SUMS = "place long, doc_id long, lang string, n_tokens long, log_prob double"
BEGIN, END = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x5E17D2A9C3B4F601)
_BEGIN_PAIR = int(T.sequence_hashes(np.array([BEGIN, BEGIN]), 2).view(np.int64)[0])

TRIPLES = "k3 long, k2 long, kc long, k1 long, kv long, begins boolean, n long"


def _padded(texts: T.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of each text between two begins and an end; where texts begin; lengths."""
    texts = T.lowered(texts)
    words = T.split_words(texts)
    hashes, counts = T.word_hashes(texts, words), words.counts
    first = np.concatenate([[0], np.cumsum(counts + 3)])
    every = np.empty(first[-1], dtype=np.uint64)
    every[first[:-1]] = every[first[:-1] + 1] = BEGIN
    every[first[1:] - 1] = END
    every[np.arange(len(hashes)) + np.repeat(first[:-1] + 2 - words.first[:-1], counts)] = hashes
    return every, first, counts + 1


def _grams(texts: T.Texts) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys of the words, pairs and triples that end at each token, and the tokens of each text."""
    every, first, lengths = _padded(texts)
    at = np.ones(len(every), dtype=bool)
    at[first[:-1]] = at[first[:-1] + 1] = False
    at = np.flatnonzero(at)
    pairs, triples = T.sequence_hashes(every, 2), T.sequence_hashes(every, 3)
    return [every[at], pairs[at - 1], triples[at - 2]], lengths, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in T.slices(batch.column(0), SLICE):
            every, _, _ = _padded(texts)
            (words, pairs, triples), _, at = _grams(texts)
            before = every[at - 1]
            contexts = T.sequence_hashes(every, 2)[at - 2]
            keys, where, n = np.unique(triples, return_index=True, return_counts=True)
            columns = [keys, pairs[where], contexts[where], words[where], before[where]]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c.view(np.int64)) for c in columns], pa.array(before[where] == BEGIN), pa.array(n)],
                names=["k3", "k2", "kc", "k1", "kv", "begins", "n"],
            )


def _discounts(table: DataFrame, column: str) -> list[float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams with counts 1 to 4."""
    rows = table.where(F.col(column) <= 4).groupBy(column).count().collect()
    n = [max({r[0]: r[1] for r in rows}.get(i, 0), 1) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max((i + 1) - (i + 2) * y * n[i + 1] / n[i], 0.0), i + 1.0) for i in range(3)]


def _cut(column: str, found: list[float]) -> Column:
    n = F.col(column)
    return F.when(n == 1, found[0]).when(n == 2, found[1]).otherwise(found[2])


def contributions(triples: DataFrame) -> tuple[DataFrame, float, float]:
    """``key, value`` for each known n-gram; the unknown word's and a text's constant terms."""
    three = materialise(
        triples.groupBy("k3").agg(
            *[F.first(c).alias(c) for c in ("k2", "kc", "k1", "kv", "begins")], F.sum("n").alias("n3")
        ),
        "triples",
    )
    # A pair counts the words before it; one that begins a text keeps its own count.
    pair_count = F.when(F.first("begins"), F.sum("n3")).otherwise(F.count("*"))
    two = three.groupBy("k2").agg(F.first("k1").alias("k1"), F.first("kv").alias("kv"), pair_count.alias("n2"))
    two = materialise(two, "pairs")
    one = two.groupBy("k1").agg(F.count("*").alias("n1"))
    d1, d2, d3 = _discounts(one, "n1"), _discounts(two, "n2"), _discounts(three, "n3")
    size = one.agg(F.sum("n1"), F.count("*"), F.sum(_cut("n1", d1))).first()
    total, distinct, mass = float(size[0]), size[1], float(size[2])
    unknown = mass / total / (distinct + 1)
    one = one.select("k1", ((F.col("n1") - _cut("n1", d1)) / total + unknown).alias("p1"))
    weigh2 = two.groupBy("kv").agg(F.sum("n2").alias("t2"), (F.sum(_cut("n2", d2)) / F.sum("n2")).alias("g2"))
    weigh3 = three.groupBy("kc").agg(F.sum("n3").alias("t3"), (F.sum(_cut("n3", d3)) / F.sum("n3")).alias("g3"))
    weigh2, weigh3 = materialise(weigh2, "weights2"), materialise(weigh3, "weights3")
    two = two.join(weigh2, "kv").join(one, "k1").withColumn(
        "p2", (F.col("n2") - _cut("n2", d2)) / F.col("t2") + F.col("g2") * F.col("p1")
    )
    two = materialise(two.select("k2", "p1", "g2", "p2"), "pair_probabilities")
    three = three.join(weigh3, "kc").join(two.select("k2", "p2"), "k2")
    p3 = (F.col("n3") - _cut("n3", d3)) / F.col("t3") + F.col("g3") * F.col("p2")
    words = one.join(weigh2, one["k1"] == weigh2["kv"], "left").select(
        F.col("k1").alias("key"), (F.ln("p1") - F.lit(np.log(unknown)) + F.ln(F.coalesce("g2", F.lit(1.0)))).alias("value")
    )
    pairs = two.join(weigh3, two["k2"] == weigh3["kc"], "left").select(
        F.col("k2").alias("key"),
        (F.ln("p2") - F.ln("p1") - F.ln("g2") + F.ln(F.coalesce("g3", F.lit(1.0)))).alias("value"),
    )
    longest = three.select(F.col("k3").alias("key"), (F.ln(p3) - F.ln("g3") - F.ln("p2")).alias("value"))
    begin = weigh2.where(F.col("kv") == int(BEGIN.view(np.int64))).agg(F.max("g2")).first()[0]
    both = weigh3.where(F.col("kc") == _BEGIN_PAIR).agg(F.max("g3")).first()[0]
    every = words.unionByName(pairs).unionByName(longest)
    return every, float(np.log(unknown)), float(np.log(begin) + np.log(both))


def _mark(slots: int):
    """A bitmap of the keys' lowest bits for each partition."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(slots, dtype=bool)
        for batch in batches:
            seen[batch.column(0).to_numpy().view(np.uint64) & np.uint64(slots - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen, bitorder="little").tobytes()], pa.binary())], names=["seen"])

    return mark


def _united(table: pa.Table) -> pa.Table:
    held = [np.frombuffer(x, np.uint8) for x in table.column("seen").to_pylist()]
    return pa.table({"seen": pa.array([np.bitwise_or.reduce(held).tobytes()], pa.binary())})


def known(table: DataFrame, entries: int) -> np.ndarray:
    """A bitmap that has a bit for every key, and for few others as long as it is not full."""
    slots = min(1 << max(16, (16 * entries - 1).bit_length()), MOST_SLOTS)
    parts = table.select("key").mapInArrow(_mark(slots), "seen binary")
    parts = parts.withColumn("g", F.spark_partition_id() % 8).groupBy("g").applyInArrow(_united, "seen binary")
    seen = np.zeros(slots // 8, np.uint8)
    for row in parts.toLocalIterator():
        seen |= np.frombuffer(bytes(row.seen), np.uint8)
    return seen


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<u4").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4")


def _sorted_shard(table: pa.Table) -> pa.Table:
    """A shard of the model as one row, its keys in order."""
    keys, values = table.column("key").to_numpy().view(np.uint64), table.column("value").to_numpy()
    order = np.argsort(keys)
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "keys": pa.array([keys[order].astype("<u8").tobytes()], pa.binary()),
            "values": pa.array([values[order].astype("<f4").tobytes()], pa.binary()),
        }
    )


_DEALT = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())),
        ("lengths", pa.list_(pa.int64())), ("n_texts", pa.int64()), ("keys", pa.binary()), ("held", pa.binary()),
        ("owners", pa.binary()), ("counts", pa.binary()),
    ]
)
DEALT = (
    "shard int, chunk long, doc_ids array<long>, langs array<string>, lengths array<long>, n_texts long, "
    "keys binary, held binary, owners binary, counts binary"
)


def _deal(sent, bits: int):
    """For each chunk and shard the distinct n-grams that may be known, and how often each text has them.

    The first shard's row names the chunk's texts.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, made = sent.value, 0
        low = np.uint64(8 * len(seen) - 1)
        bounds = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
        for batch in batches:
            for texts in T.slices(batch.column(2), SLICE):
                grams, lengths, _ = _grams(texts)
                text_of = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
                keys, owners = [], []
                for own in grams:
                    slot = own & low
                    at = np.flatnonzero((seen[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                    keys.append(own[at])
                    owners.append(text_of[at])
                keys, owners = np.concatenate(keys), np.concatenate(owners)
                # Stable, so the texts of an n-gram are in order.
                order = np.argsort(keys, kind="stable")
                keys, owners = keys[order], owners[order]
                other = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
                pair = other | np.append(True, owners[1:] != owners[:-1])[: len(keys)]
                pairs = np.flatnonzero(pair)
                counts = np.diff(np.append(pairs, len(keys)))
                distinct = keys[other]
                first = np.append(np.flatnonzero(other[pairs]), len(pairs))
                cuts = np.concatenate([[0], np.searchsorted(distinct, bounds), [len(distinct)]])
                n = texts.high - texts.low
                ids, langs = (batch.column(i).slice(texts.low, n).to_pylist() for i in (0, 1))
                for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if shard and a == b:
                        continue
                    own = slice(first[a], first[b])
                    names = [None, None, None] if shard else [ids, langs, lengths.tolist()]
                    row = {
                        "shard": [shard], "chunk": [(TaskContext.get().partitionId() << 22) + made],
                        "doc_ids": [names[0]], "langs": [names[1]], "lengths": [names[2]], "n_texts": [n],
                        "keys": [distinct[a:b].astype("<u8").tobytes()], "held": [_pack(np.diff(first[a : b + 1]))],
                        "owners": [_pack(owners[pairs[own]])], "counts": [_pack(counts[own])],
                    }
                    yield pa.RecordBatch.from_pydict(row, schema=_DEALT)
                made += 1

    return deal


def _add(dealt: pa.Table, model: pa.Table) -> pa.Table:
    """What a shard's n-grams add to texts, by their place; the first shard has every text, with its name."""
    known = np.frombuffer(model.column("keys")[0].as_py(), "<u8") if model.num_rows else np.zeros(0, "<u8")
    values = np.frombuffer(model.column("values")[0].as_py(), "<f4") if model.num_rows else np.zeros(0, "<f4")
    out: list[list] = [[], [], [], [], []]
    for i in range(dealt.num_rows):
        row = {name: dealt.column(name)[i].as_py() for name in _DEALT.names}
        keys = np.frombuffer(row["keys"], "<u8")
        own = np.zeros(len(keys))
        if len(known):
            where = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            own = np.where(known[where] == keys, values[where], 0.0).astype(np.float64)
        weights = np.repeat(own, _unpack(row["held"])) * _unpack(row["counts"])
        total = np.bincount(_unpack(row["owners"]), weights, row["n_texts"])
        named = row["doc_ids"] is not None
        at = np.arange(row["n_texts"]) if named else np.flatnonzero(total)
        names = [row["doc_ids"], row["langs"], row["lengths"]] if named else [[None] * len(at)] * 3
        for held, more in zip(out, ((at + (row["chunk"] << 20)).tolist(), *names, total[at].tolist()), strict=True):
            held += more
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64()]
    names = ["place", "doc_id", "lang", "n_tokens", "log_prob"]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, out, kinds, strict=True)})


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """``key, lang, n_tokens, perplexity, threshold, kept`` for each row.

    ``labels`` has ``key, quality, toxic``; trusted are rows of quality 1 that are
    not toxic.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("binary").alias("text"),
    )
    digest = F.md5(F.col(key).cast("string"))
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").where(F.col(key).isNotNull())
    good = good.select(F.col(key).cast("long").alias("doc_id"), digest.alias("order")).distinct()
    half = F.conv(F.substring("order", 1, 1), 16, 10).cast("int") % 2
    taught = materialise(good.where(half == 0).select("doc_id"), "taught")
    lessons = rows.join(taught, "doc_id").select("text").where("length(text) > 0")
    if lessons.isEmpty():
        if docs.isEmpty():
            names = f"{key} long, {lang} string, n_tokens long, perplexity double, threshold double, kept boolean"
            return spark.createDataFrame([], names)
        raise ValueError("no trusted text")
    table, unknown, begin = contributions(lessons.mapInArrow(_count, TRIPLES))
    table = materialise(table, "contributions")
    entries = table.count()
    bits = max(0, int(np.ceil(np.log2(max(entries, 1) / SHARD_ENTRIES))))
    shard = F.shiftrightunsigned("key", 64 - bits).cast("int") if bits else F.lit(0)
    model = table.select(shard.alias("shard"), "key", F.col("value").cast("float").alias("value"))
    model = model.groupBy("shard").applyInArrow(_sorted_shard, "shard int, keys binary, values binary")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    salts = -(-size // (GROUP_BYTES << bits)) or 1
    model = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sent = spark.sparkContext.broadcast(known(table, entries))
    dealt = rows.mapInArrow(_deal(sent, bits), DEALT)
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int"))
    parts = dealt.groupBy("shard", "salt").cogroup(model.groupBy("shard", "salt")).applyInArrow(_add, SUMS)
    by_text = parts.groupBy("place").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "lang", "n_tokens")], F.sum("log_prob").alias("log_prob")
    )
    total = F.col("log_prob") + F.col("n_tokens") * unknown + begin
    scored = by_text.select("doc_id", F.col("lang").alias("_lang"), "n_tokens", (-total / F.col("n_tokens")).alias("log_perplexity"))
    scored = materialise(scored, "scored")
    tests = scored.join(good.where(half == 1).select("doc_id"), "doc_id", "left_semi")
    tests = tests.where("n_tokens > 1")
    level = F.percentile_approx("log_perplexity", quantile, 10_000)
    own = tests.groupBy(F.col("_lang").alias("_l")).agg(level.alias("_t"), F.count("*").alias("_n"))
    overall = tests.agg(level.alias("_all"))
    own = own.where(F.col("_n") >= LEAST_HELD)
    limit = float(overall.first()[0] or np.inf)
    both = scored.join(own, scored["_lang"].eqNullSafe(own["_l"]), "left")
    threshold = F.coalesce("_t", F.lit(limit))
    return both.select(
        F.col("doc_id").alias(key), F.col("_lang").alias(lang), "n_tokens",
        F.exp("log_perplexity").alias("perplexity"), F.exp(threshold).alias("threshold"),
        ((F.col("n_tokens") > 1) & (F.col("log_perplexity") <= threshold)).alias("kept"),
    )
