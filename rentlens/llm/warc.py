"""WARC archives: one gzip member per record, written by many tasks and read back in sequence.

An archive is a row (archive, content) of a table, so that any store that Spark reaches can hold it; its content is a
``.warc.gz`` file of whole records of about ``ARCHIVE`` bytes. Pages are archived where they are read: only digests are
compared across tasks, and what copies a payload has travels as (digest, smallest key). Archives are read where they lie.
The reader also takes archives of any size that are cut into rows (archive, chunk, content); a record may cross chunks. It
inflates piece by piece, starts anew at each member's end, takes each block by its Content-Length and checks its digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import looked_up, stored

ARCHIVE = 4 << 20  # an archive is closed when it has so many bytes
PIECE = 1 << 14  # bytes that are inflated at a time; the rest of a piece is copied at every record's end
BROADCAST_ROWS = 200_000  # payloads with copies that are sent to every executor (20 MB), beyond that only the frequent ones
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "archive long, content binary"
RECORDS = (
    "page_id long, uri string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "block_ok boolean, payload_ok boolean, payload binary"
)


class DamagedArchive(ValueError):
    """The bytes of an archive break the format."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The uncompressed bytes of one record; ``refers_to`` makes it a revisit, whose block has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    clean = "".join(c for c in uri or "" if c.isprintable())
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", clean),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def members(chunks: Iterator[bytes | memoryview]) -> Iterator[bytes]:
    """The inflated content of each gzip member of a stream of chunks."""
    inflate, parts = zlib.decompressobj(31), []
    started = False
    for chunk in chunks:
        data = chunk
        while len(data):
            started = True
            try:
                parts.append(inflate.decompress(data))
            except zlib.error as e:
                raise DamagedArchive(f"a record cannot be inflated: {e}") from e
            data = b""
            if inflate.eof:
                yield b"".join(parts)
                data, inflate, parts, started = inflate.unused_data, zlib.decompressobj(31), [], False
    if started:
        raise DamagedArchive("the archive ends inside a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and block of a record."""
    head, found, rest = data.partition(END)
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        raise DamagedArchive("a record has no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.decode("utf-8", "replace").partition(":") for line in lines[1:])}
    if not fields.get("content-length", "").isdigit():
        raise DamagedArchive("a record has no Content-Length")
    length = int(fields["content-length"])
    if rest[length:] != END:
        raise DamagedArchive("a record is longer or shorter than its Content-Length")
    return fields, rest[:length]


def _digest_ok(stated: str, data: bytes) -> bool:
    return stated.removeprefix("sha1:") == sha1_base32(data)


def _row(data: bytes) -> dict:
    fields, block = parsed(data)
    kind = fields.get("warc-type", "")
    head, _, payload = block.partition(END)
    http = {k.strip().lower(): v.strip() for k, _, v in (line.decode("latin-1").partition(":") for line in head.split(b"\r\n")[1:])}
    number = lambda text: int(text) if text else None
    full = kind == "response"
    return {
        "page_id": number(fields.get("x-page-id")),
        "uri": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": len(payload) if full else number(http.get("content-length")),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": number(fields.get("x-refers-to-page-id")),
        "block_ok": _digest_ok(fields.get("warc-block-digest", ""), block),
        "payload_ok": _digest_ok(fields.get("warc-payload-digest", ""), payload) if full else None,
        "payload": payload if full else None,
    }


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of a task, one after the other."""
    pending, number = bytearray(), TaskContext.get().partitionId() << 32

    def out() -> pa.RecordBatch:
        nonlocal number
        number += 1
        return pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), pa.array([bytes(pending)], pa.binary())], ["archive", "content"])

    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
            page_id, url, html, refers_to = (v.as_py() for v in row)
            pending += member(record(page_id, url, html.encode(), refers_to))
            if len(pending) >= ARCHIVE:
                yield out()
                pending.clear()
    if pending:
        yield out()


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The archives of the pages as rows (archive, content), written to the shared folder.

    Of pages with equal payloads the one with the smallest key is a response, the others revisit it; rows that repeat this
    key with this payload are responses too. A missing html is an empty payload, equal to other empty ones. Pages without a
    key are responses if no keyed page has their payload.
    """
    html = F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("html", 256)))
    copies = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null")
    copies = stored(copies, "copies")
    if copies.count() <= broadcast_rows:
        told = rows.join(F.broadcast(copies.drop("n")), "digest", "left")
    else:
        told = looked_up(rows, copies, ["digest"], "n", keep_all=True)
    told = told.withColumn("refers_to", F.expr("if(first_id <=> page_id, null, first_id)"))
    return stored(told.select("page_id", "url", "html", "refers_to").mapInArrow(_write, ARCHIVES), "warc")


def _read(with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [(n, types[c.split()[1]]) for n, c in zip(names, RECORDS.split(", "), strict=True) if with_payload or n != "payload"]

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[bytes]]:
        rows = ((a, c) for b in batches for a, c in zip(b.column("archive").to_pylist(), b.column("content"), strict=True))
        ahead = next(rows, None)

        def one(archive: int) -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[0] == archive:
                content = memoryview(ahead[1].as_buffer())
                ahead = next(rows, None)
                for i in range(0, len(content), PIECE):
                    yield content[i : i + PIECE]

        while ahead is not None:
            yield one(ahead[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], t) for n, t in fields], [n for n, _ in fields])

        for chunks in archives(batches):
            for data in members(chunks):
                held.append(_row(data))
                size += len(data) if with_payload else 500
                if size > 4 << 20:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives given as rows (archive, content), or (archive, chunk, content) with the chunks of an archive in
    several rows, and the outcome of both digest checks.

    ``payload`` is NULL for revisits. Bytes that break the format raise DamagedArchive; a wrong digest only shows in
    ``block_ok`` or ``payload_ok``. Rows without content are passed over.
    """
    schema = RECORDS if with_payload else RECORDS.removesuffix(", payload binary")
    ordered = archives.where("content is not null")
    if "chunk" in archives.columns:
        ordered = ordered.select("archive", "chunk", "content").repartition("archive").sortWithinPartitions("archive", "chunk")
    return ordered.select("archive", "content").mapInArrow(_read(with_payload), schema)
