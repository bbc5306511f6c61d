"""WARC derivatives: a metadata and a plain-text conversion record for each response.

A record is its header block, its block, and two empty lines, as bytes. Response
records hold an HTTP response; from each come

* a ``metadata`` record (``application/warc-fields``) with the source's HTTP status and
  headers, title, language and links;
* a ``conversion`` record with the page's text as ``text/plain``.

Both refer to the response by ``WARC-Refers-To`` with the URI and date of the source
(``WARC-Refers-To-Target-URI``, ``WARC-Refers-To-Date``), name each other by
``WARC-Concurrent-To``, carry the source's payload digest in ``WARC-Source-Payload-Digest``
and digests of their own block. Identifiers are UUIDs of the source's identifier
and the kind, so a repeated run gives the same records.

A response whose digest does not match its bytes, or that is no whole record, is
not derived; it comes out as a row with ``error`` and no records. Null or empty
HTML gives records with empty text. A null URL leaves the URI headers out. Rows
with equal keys give records of equal identifiers only if URL and HTML are equal
too. An empty table gives no rows. Pages are read whole; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
FILE_BYTES = 32 << 20
RESPONSES = "page_id long, record binary"
DERIVED = """page_id long, response_id string, metadata_id string, conversion_id string,
    refers_to string, target_uri string, payload_digest string, block_digest string,
    n_links long, text string, metadata binary, conversion binary, error string"""

_DROPPED = re.compile(r"<!--.*?-->|<(script|style|template|noscript)\b.*?</\1\s*>|<!doctype[^>]*>", re.S | re.I)
_BREAKS = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|section|article|header|footer|nav|aside|main"
    r"|pre|blockquote|form|title|head|body|html)\b[^>]*>", re.I
)
_TAG = re.compile(r"<(?:[a-zA-Z/!?][^>]*)>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLANK = re.compile(r"[ \t\r\f\v ]+")


class BadRecord(ValueError):
    pass


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(map(str, parts)))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record; header values lose their line breaks, and the length goes last."""
    lines = [f"{name}: {' '.join(value.split())}" for name, value in headers]
    lines.append(f"Content-Length: {len(block)}")
    return b"\r\n".join([VERSION, *[line.encode() for line in lines], b"", block, b"", b""])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and the block of one record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/"):
        raise BadRecord("no record header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        raise BadRecord("cut block")
    return headers, rest[: int(length)]


def response(url: str | None, body: bytes, key: object, date: str = DATE) -> bytes:
    """A response record of a page."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(body)).encode() + b"\r\n\r\n" + body
    )
    uri = [("WARC-Target-URI", url)] if url is not None else []
    return record(
        [
            ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url, digest(body))),
            *uri, ("WARC-Date", date), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(http)),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        http,
    )


def plain_text(page: str) -> str:
    """The page's text: a line for each block with text, white space made single."""
    page = _BREAKS.sub("\n", _DROPPED.sub(" ", page))
    page = html.unescape(_TAG.sub("", page))
    lines = (_BLANK.sub(" ", line).strip() for line in page.split("\n"))
    return "\n".join(line for line in lines if line)


def derive(data: bytes) -> dict:
    """Both records of a response record, and what they say."""
    headers, block = parse(data)
    if headers.get("warc-type") != "response":
        raise BadRecord("not a response")
    if headers.get("warc-block-digest", digest(block)) != digest(block):
        raise BadRecord("wrong block digest")
    head, _, body = block.partition(b"\r\n\r\n")
    status, *http = head.decode("latin-1").split("\r\n")
    payload = digest(body)
    if headers.get("warc-payload-digest", payload) != payload:
        raise BadRecord("wrong payload digest")
    source, uri, date = headers.get("warc-record-id", ""), headers.get("warc-target-uri"), headers.get("warc-date", DATE)
    page = body.decode("utf-8", "replace")
    text, links = plain_text(page), [html.unescape(next(filter(None, m), "")) for m in _LINK.findall(page)]
    title, lang = _TITLE.search(page), _LANG.search(page)
    ids = {kind: record_id(kind, source) for kind in ("metadata", "conversion")}
    fields = [("http-status", status.partition(" ")[2])]
    fields += [("http-header", line) for line in http]
    fields += [("title", " ".join(plain_text(title[1]).split()))] if title else []
    fields += [("language", lang[1])] if lang else []
    fields += [("outlink", " ".join(link.split())) for link in links]
    meta = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()

    def linked(kind: str, other: str, content: str, own: bytes) -> bytes:
        about = [("WARC-Target-URI", uri), ("WARC-Refers-To-Target-URI", uri)] if uri is not None else []
        return record(
            [
                ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source), *about,
                ("WARC-Date", date), ("WARC-Refers-To-Date", date), ("WARC-Concurrent-To", ids[other]),
                ("WARC-Source-Payload-Digest", payload), ("WARC-Block-Digest", digest(own)),
                ("Content-Type", content),
            ],
            own,
        )

    return {
        "response_id": source, "metadata_id": ids["metadata"], "conversion_id": ids["conversion"],
        "refers_to": source, "target_uri": uri, "payload_digest": payload,
        "block_digest": digest(text.encode()), "n_links": len(links), "text": text,
        "metadata": linked("metadata", "conversion", "application/warc-fields", meta),
        "conversion": linked("conversion", "metadata", "text/plain; charset=utf-8", text.encode()),
        "error": None,
    }


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_FIELDS = [tuple(field.split()) for field in DERIVED.replace("\n", " ").split(",")]


def page_responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Response records of a table of pages."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            made = [response(u, h or b"", k) for k, u, h in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["page_id", "record"])

    rows = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(body).cast("binary"))
    return rows.mapInArrow(build, RESPONSES)


def derivatives(responses: DataFrame) -> DataFrame:
    """One row for each response record (``page_id, record``) with its two derivatives."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    row = derive(data.as_py() or b"")
                except BadRecord as error:
                    row = {"error": str(error)}
                rows.append({"page_id": key, **row})
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(name) for r in rows], _ARROW[kind]) for name, kind in _FIELDS],
                names=[name for name, _ in _FIELDS],
            )

    return responses.mapInArrow(made, DERIVED)


def write_records(derived: DataFrame, folder: str) -> DataFrame:
    """Write both records of each row to ``.warc.gz`` files, a gzip member for each record.

    Returns ``file, n_records``. ``folder`` must be one that all executors write to. A task
    closes a file at ``FILE_BYTES``, and renames it when whole, so a repeated task
    leaves the same files.
    """
    fs, root = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, attempt, number, held, size, made = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, [], 0, []

        def close():
            nonlocal number, held, size
            name = f"derived-{own:06d}-{number:04d}.warc.gz"
            fs_, root_ = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)
            with fs_.open_output_stream(f"{root_}/_{name}.{attempt}", compression=None) as out:
                out.write(b"".join(held))
            fs_.move(f"{root_}/_{name}.{attempt}", f"{root_}/{name}")
            made.append((name, len(held)))
            number, held, size = number + 1, [], 0

        for batch in batches:
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for data in pair:
                    held.append(gzip.compress(data, 6, mtime=0))
                    size += len(held[-1])
                if size >= FILE_BYTES:
                    close()
        if held:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
            names=["file", "n_records"],
        )

    whole = derived.where("error is null").select("metadata", "conversion")
    return whole.mapInArrow(write, "file string, n_records long")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``type, record_id, refers_to, block`` of every record in the folder's files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(0).to_pylist():
                whole = gzip.decompress(data)
                while whole:
                    headers, block = parse(whole)
                    end = whole.index(b"\r\n\r\n") + 4 + len(block)
                    whole = whole[end + 4 :]
                    rows.append((headers.get("warc-type"), headers.get("warc-record-id"), headers.get("warc-refers-to"), block))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["type", "record_id", "refers_to", "block"]
            )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(read, "type string, record_id string, refers_to string, block binary")
