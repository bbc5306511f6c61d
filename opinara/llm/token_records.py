"""Token-ID output: length-delimited binary records with a separate offset index.

A shard is a file of frames, one for each text, in ascending order of the key:

    length    8 bytes   little-endian, of the payload
    check     4 bytes   masked CRC-32 of the length's bytes
    payload   length    1 byte: 1 if there is a key, 8 bytes: the key, signed, then the
                        token IDs; all little-endian
    check     4 bytes   masked CRC-32 of the payload

IDs are unsigned and take ``width`` bytes each: two if the vocabulary has at most
65,536 entries, else four.

The masked check of ``c`` is ``rotate_right(c, 15) + 0xA282EAD8`` modulo 2^32,
so that a check of bytes that hold checks is safe. Beside each shard, an index
file has for each frame its offset, its number of tokens and its key, so a
reader can fetch frames in any order without scanning shards.

Texts are dealt to tasks by ranges of the key and sorted within the task; shard
names follow key order. A shard is closed at ``shard_bytes``, so no reader ever
holds more than that and one text. A task writes under a name of its own attempt
and renames when the file is whole, so a repeated task leaves the same files.

Texts: null counts as empty and gives the end ID alone. Null keys come first.
Rows with equal keys all stay, in the order of their bytes. An empty table gives
no shards and an empty table of records. Other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.llm import text as T
from opinara.session import scratch_path

SHARD_BYTES = 16 << 20
END_ID = 1
# Distinct pieces of words whose IDs a task remembers.
REMEMBERED = 200_000
# Bytes of text encoded at a time.
SLICE = 1 << 20
# Marks that never join the letters before them; the apostrophe may.
MARKS = b"!#$%&()*+,-./:;<=>?@[]^_`{|}~"
IS_MARK = np.zeros(256, dtype=bool)
IS_MARK[list(MARKS)] = True
# Fixed value: what the mask adds.
MASK_DELTA = 0xA282EAD8

INDEX_ENTRY = np.dtype([("offset", "<u8"), ("n_tokens", "<u4"), ("has_key", "<u4"), ("key", "<i8")])
INDEX_SCHEMA = "shard string, key long, offset long, n_tokens long"
RECORD_SCHEMA = (
    "shard string, position long, offset long, key long, n_tokens long, ids_crc32 long"
)
KEY = struct.Struct("<Bq")


class CorruptRecord(ValueError):
    pass


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    return ((check >> 15 | check << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))
    )


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and payload of each frame; raises if a check fails or a frame is cut."""
    at = 0
    while at < len(data):
        if at + 12 > len(data):
            raise CorruptRecord(f"cut header at {at}")
        (length,), (check,) = struct.unpack_from("<Q", data, at), struct.unpack_from("<I", data, at + 8)
        if check != masked(data[at : at + 8]):
            raise CorruptRecord(f"wrong length check at {at}")
        end = at + 12 + length
        if end + 4 > len(data):
            raise CorruptRecord(f"cut payload at {at}")
        payload = data[at + 12 : end]
        if struct.unpack_from("<I", data, end)[0] != masked(payload):
            raise CorruptRecord(f"wrong payload check at {at}")
        yield at, payload
        at = end + 4


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """A worker's tokenizer."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """What byte-level tokenizers write for a byte: itself if it prints, else the next free character."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {b: chr(b if b in prints else next(free)) for b in range(256)}


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Token IDs of texts, as little-endian unsigned integers.

    The tokenizer drops white space and never joins what it separates, so a
    text's IDs are its words' IDs in order. It lowers case and parts letters from other
    marks, so a word that ends in a lower-case ASCII letter and then ASCII marks has the
    IDs of its stem and of the marks. These pieces of a slice's words are told apart by
    64-bit hashes; each distinct one is encoded once, and the texts' IDs are gathered
    from theirs. A piece of letters alone, already in the tokenizer's normal form, is
    one word to its byte-pair model, which is asked directly.

    Pieces are remembered from slice to slice, up to ``REMEMBERED``, and go with the
    encoder, which lives as long as its task.
    """

    def __init__(self, path: str, width: int):
        self.kind = np.dtype(f"<u{width}")
        self.tokenizer = _tokenizer(path)
        self.known: dict[int, bytes] = {}

    def learn(self, names: list[int], pieces: list[bytes]) -> None:
        merge, found, sizes, single, other = self.tokenizer.model.tokenize, [], [], [], []
        for name, piece in zip(names, pieces, strict=True):
            held = piece.decode("utf-8", "replace")
            if held.isascii():  # in lower case already
                plain, letters = held.isalpha(), held
            else:
                plain = held.isalpha() and held == held.lower() and unicodedata.is_normalized("NFC", held)
                letters = piece.decode("latin-1").translate(BYTE_LETTERS)
            if not plain:
                other.append((name, held))
                continue
            tokens = merge(letters)
            single.append(name)
            sizes.append(len(tokens))
            found += [token.id for token in tokens]
        packed = np.array(found, dtype=self.kind).tobytes()
        ends = np.cumsum([0, *sizes]) * self.kind.itemsize
        for name, (low, high) in zip(single, pairwise(ends.tolist()), strict=True):
            self.known[name] = packed[low:high]
        for low in range(0, len(other), 4096):
            part = other[low : low + 4096]
            coded = self.tokenizer.encode_batch_fast([held for _, held in part], add_special_tokens=False)
            for (name, _), one in zip(part, coded, strict=True):
                self.known[name] = np.asarray(one.ids, dtype=self.kind).tobytes()

    def encode(self, texts: T.Texts) -> list[bytes]:
        words, lowered = T.split_words(texts), T.lowered(texts)
        low = lowered.data
        stem_ends = _stem_ends(low, words)
        # A word with "<|" may hold a special token, so it stays as it is.
        opening = np.flatnonzero((low[:-1] == ord("<")) & (low[1:] == ord("|")))
        apart = np.zeros(len(words.starts), dtype=bool)
        apart[np.searchsorted(words.starts, opening, side="right") - 1] = True
        stem_ends[apart] = words.ends[apart]
        parted = stem_ends < words.ends
        starts = np.insert(words.starts, np.flatnonzero(parted) + 1, stem_ends[parted])
        ends = np.insert(stem_ends, np.flatnonzero(parted) + 1, words.ends[parted])
        pieces = np.concatenate([[0], np.cumsum(1 + parted)])
        hashes = T.span_hashes(lowered.prefix_hashes(), starts, ends)
        if apart.any():
            own = T.span_hashes(texts.prefix_hashes(), words.starts[apart], words.ends[apart])
            hashes[pieces[:-1][apart]] = T.mix(own ^ np.uint64(1))
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        names = distinct.tolist()
        new = [i for i, name in enumerate(names) if name not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(range(len(names)))
        whole = np.zeros(len(starts), dtype=bool)
        whole[pieces[:-1][apart]] = True
        data, plain, where = texts.data.tobytes(), low.tobytes(), at[new]
        spans = zip(starts[where].tolist(), ends[where].tolist(), whole[where].tolist(), strict=True)
        self.learn([names[i] for i in new], [(data if raw else plain)[a:b] for a, b, raw in spans])
        held = [self.known[name] for name in names]
        width = self.kind.itemsize
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // width
        flat, begins = np.frombuffer(b"".join(held), self.kind), np.cumsum(sizes) - sizes
        counts = sizes[which]
        first = np.concatenate([[0], np.cumsum(counts)])
        packed = flat[np.repeat(begins[which] - first[:-1], counts) + np.arange(first[-1])].tobytes()
        cuts = (first[pieces[words.first]] * width).tolist()
        return [packed[a:b] for a, b in pairwise(cuts)]


def _stem_ends(low: np.ndarray, words: T.Words) -> np.ndarray:
    """Where each word's marks begin, if a letter a to z stands before them; else its end."""
    other = np.maximum.accumulate(np.where(IS_MARK[low], -1, np.arange(len(low))))
    last = other[words.ends - 1]
    lettered = (last >= words.starts) & (low[last] >= 97) & (low[last] <= 122)
    return np.where(lettered, last + 1, words.ends)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def id_width(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


class _ShardWriter:
    def __init__(self, folder: str, task: int, width: int):
        self.fs, self.root = _filesystem(folder)
        self.width = width
        self.task, self.number, self.out = task, 0, None
        self.attempt = uuid.uuid4().hex
        self.index: list[tuple] = []

    def add(self, key: int | None, ids: bytes) -> tuple[str, int]:
        if self.out is None:
            self.name = f"shard-{self.task:06d}-{self.number:06d}"
            self.out = self.fs.open_output_stream(f"{self.root}/_{self.name}.{self.attempt}")
            self.offset = 0
        at, framed = self.offset, frame(KEY.pack(key is not None, key or 0) + ids)
        self.out.write(framed)
        self.offset += len(framed)
        self.index.append((at, len(ids) // self.width, key is not None, key or 0))
        name = self.name
        if self.offset >= SHARD_BYTES:
            self.close()
        return name, at

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        entries = np.array(self.index, dtype=INDEX_ENTRY).tobytes()
        with self.fs.open_output_stream(f"{self.root}/_{self.name}.idx.{self.attempt}") as out:
            out.write(entries)
        for suffix in (".idx", ""):
            made = f"{self.root}/_{self.name}{suffix}.{self.attempt}"
            ending = ".idx" if suffix else ".rec"
            self.fs.move(made, f"{self.root}/{self.name}{ending}")
        self.out, self.index, self.number = None, [], self.number + 1


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Encode every text, write the shards and their index; return the index's rows.

    ``folder`` must be one that all executors write to. The rows returned are
    those of the index files, read from what the writing tasks report.
    """
    spark = docs.sparkSession
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    width = id_width(tokenizer)
    ending = np.array([end_id], dtype=f"<u{width}").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = Encoder(tokenizer, width), None
        for batch in batches:
            if writer is None:
                writer = _ShardWriter(folder, TaskContext.get().partitionId(), width)
            keys = batch.column(0).to_pylist()
            out: list[tuple] = []
            for texts in T.slices(batch.column(1), SLICE):
                for k, ids in zip(keys[texts.low : texts.high], encoder.encode(texts), strict=True):
                    name, at = writer.add(k, ids + ending)
                    out.append((name, k, at, len(ids) // width + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.string()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.int64()),
                    pa.array([r[3] for r in out], pa.int64()),
                ],
                names=["shard", "key", "offset", "n_tokens"],
            )
        if writer is not None:
            writer.close()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    dealt = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    path = scratch_path(spark, "record_index")
    dealt.mapInArrow(write, INDEX_SCHEMA).write.parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def decode(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    """Key and token IDs, these as unsigned 32-bit integers."""
    held, key = KEY.unpack_from(payload)
    return key if held else None, np.frombuffer(payload[KEY.size :], f"<u{width}").astype("<u4")


def read_index(folder: str, shard: str) -> np.ndarray:
    """The shard's index: offset, number of tokens, key of each record."""
    fs, root = _filesystem(folder)
    with fs.open_input_stream(f"{root}/{shard}.idx") as held:
        return np.frombuffer(held.read(), dtype=INDEX_ENTRY)


def fetch(folder: str, shard: str, offset: int, width: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset, for reading in shuffled order."""
    fs, root = _filesystem(folder)
    with fs.open_input_file(f"{root}/{shard}.rec") as held:
        (length,) = struct.unpack("<Q", held.read_at(8, offset))
        (_, payload), *_ = frames(held.read_at(length + 16, offset))
    return decode(payload, width)


def read_records(spark: SparkSession, folder: str, width: int) -> DataFrame:
    """Every record of the shards, its checks verified, in the form of digests.

    ``position`` is the record's number in its shard. ``n_tokens`` and
    ``ids_crc32`` cover all its IDs, the end ID too.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for position, (at, payload) in enumerate(frames(data.as_py())):
                    key, ids = decode(payload, width)
                    rows.append((shard, position, at, key, len(ids), zlib.crc32(ids.tobytes())))
                columns = zip(*rows, strict=True) if rows else [()] * 6
                kinds = [pa.string()] + [pa.int64()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=["shard", "position", "offset", "key", "n_tokens", "ids_crc32"],
                )

    name = F.regexp_extract("path", r"(shard-\d+-\d+)\.rec", 1).alias("shard")
    # A shard, hence a row, holds at most SHARD_BYTES and one text.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.rec").load(folder)
    return files.select(name, "content").mapInArrow(parse, RECORD_SCHEMA)


def with_starts(records: DataFrame) -> DataFrame:
    """Add ``start``: the IDs of all records before, in key order.

    Sums run inside a shard; only the shards' totals, one row for each, are
    summed across shards.
    """
    inside = Window.partitionBy("shard").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    bases = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        records.withColumn("_own", own)
        .join(bases, "shard")
        .withColumn("start", F.col("_base") + F.col("_own"))
        .drop("_own", "_base")
    )


def encoded_documents(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the documents as records and digest what the files hold."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    write_records(docs, folder, tokenizer)
    path = scratch_path(spark, "record_digests")
    fs, root = _filesystem(folder)
    if not any(f.base_name.endswith(".rec") for f in fs.get_file_info(pafs.FileSelector(root))):
        return spark.createDataFrame(
            [], "doc_id long, start long, n_tokens long, ids_crc32 long, shard string"
        )
    read_records(spark, folder, id_width(tokenizer)).write.parquet(path)
    records = spark.read.schema(RECORD_SCHEMA).parquet(path)
    return with_starts(records).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard"
    )
