"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

``write_warc`` writes a record per page: a ``response`` with its payload, or a ``revisit`` without it
when an equal payload stands in the record of a smaller ``page_id``. Each task writes its own files into
a shared folder and reports them; only reported files count, so a repeated or lost task leaves nothing
that is read. ``read_warc`` goes through every file from start to end: it inflates one member at a time
in small pieces, frames blocks by Content-Length and checks block and payload digests.

Defined results: a null payload is empty. A null ``page_id`` sorts after all others; records of rows
with equal ``page_id`` and equal payload have the same type. A null URL is left out of the record and
read back as null. An empty table writes no file and reads as no record. A damaged archive raises.
Only the columns named in the arguments are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import ship

ROLL_BYTES = 256 << 20  # an archive is closed once it holds so much
READ_BYTES = 64 << 10
HEAD_BYTES = 1 << 20  # no header of a record may be longer
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
URN = "urn:page:"

WRITTEN = "path string, n_records long, n_bytes long"
RECORDS = ("record_type string, page_id long, url string, refers_to long, payload_bytes long, "
           "payload_digest string")


def _label(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool,
                 level: int = 6) -> bytes:
    """One WARC record as one gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = [http] if is_revisit else [http, payload]
    block_sha = hashlib.sha1()
    for part in block:
        block_sha.update(part)
    head = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": f"<{URN}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha1:{_label(block_sha.digest())}",
        "WARC-Payload-Digest": f"sha1:{_label(hashlib.sha1(payload).digest())}",
        "Content-Length": str(sum(map(len, block))),
    }
    if url is not None:
        # Blanks and control characters would break the header line.
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if is_revisit:
        head["WARC-Profile"] = REVISIT_PROFILE
        head["WARC-Refers-To"] = f"<{URN}{'' if refers_to is None else refers_to}>"
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [f"WARC/1.1\r\n{lines}\r\n".encode(), *block, b"\r\n\r\n"]
    return b"".join([*map(packer.compress, parts), packer.flush()])


class Member:
    """The content of one gzip member, inflated piece by piece."""

    def __init__(self, raw, pending: bytes) -> None:
        self.raw, self.pending, self.ready = raw, pending, b""
        self.inflater = zlib.decompressobj(31)

    def more(self) -> bool:
        while not self.inflater.eof:
            data = self.pending or self.raw.read(READ_BYTES)
            if not data:
                raise ValueError("archive ends inside a record")
            piece = self.inflater.decompress(data, READ_BYTES)
            self.pending = self.inflater.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    def head(self, most: int) -> bytes:
        """Everything up to and including the next empty line."""
        while (end := self.ready.find(b"\r\n\r\n")) < 0:
            if len(self.ready) > most or not self.more():
                raise ValueError("a record has no end of its header")
        out, self.ready = self.ready[:end + 4], self.ready[end + 4:]
        return out

    def take(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.ready and not self.more():
                raise ValueError("a record is shorter than its Content-Length")
            piece, self.ready = self.ready[:length], self.ready[length:]
            length -= len(piece)
            yield piece

    def close(self) -> bytes:
        """The bytes after this member; raises when the record is longer than it says."""
        if b"".join(self.take(4)) != b"\r\n\r\n" or self.ready or self.more():
            raise ValueError("a record does not end where its Content-Length says")
        return self.inflater.unused_data or self.pending


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _urn(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(URN)
    return int(number) if number else None


def read_records(raw, keep_payload: bool = False) -> Iterator[dict]:
    """All records of an open archive, each verified."""
    pending = raw.read(READ_BYTES)
    while pending:
        member = Member(raw, pending)
        fields = _fields(member.head(HEAD_BYTES))
        left = int(fields["content-length"])
        http = member.head(min(left, HEAD_BYTES) + READ_BYTES)
        block_sha, payload_sha, kept = hashlib.sha1(http), hashlib.sha1(), []
        for piece in member.take(left - len(http)):
            block_sha.update(piece)
            payload_sha.update(piece)
            if keep_payload:
                kept.append(piece)
        pending = member.close() or raw.read(READ_BYTES)
        said, is_revisit = fields["warc-payload-digest"], fields["warc-type"] == "revisit"
        if fields["warc-block-digest"] != f"sha1:{_label(block_sha.digest())}" or (
                not is_revisit and said != f"sha1:{_label(payload_sha.digest())}"):
            raise ValueError(f"digest of {fields['warc-record-id']} does not match")
        uri = fields.get("warc-target-uri")
        yield {
            "record_type": fields["warc-type"],
            "page_id": _urn(fields["warc-record-id"]),
            "url": uri and re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), uri),
            "refers_to": _urn(fields.get("warc-refers-to")),
            "payload_bytes": int(_fields(http)["content-length"]),
            "payload_digest": said.removeprefix("sha1:"),
            **({"payload": b"".join(kept)} if keep_payload else {}),
        }


def _writer(folder: str, level: int, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        out, path, n, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{path}", compression=None)
                data = record_bytes(row["page_id"], row["url"], row["payload"], row["refers_to"], row["is_revisit"], level)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "n_records", "n_bytes"])
    return write


def _reader(folder: str, keep_payload: bool, batch_bytes: int = 16 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        kinds = [("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()),
                 ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        schema = pa.schema(kinds + ([("payload", pa.binary())] if keep_payload else []))
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_stream(f"{base}/{path}", compression=None, buffer_size=READ_BYTES) as raw:
                    for row in read_records(raw, keep_payload):
                        rows.append(row)
                        held += 500 + len(row.get("payload", b""))
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
    return read


def revisits(rows: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of every record that repeats the payload of a smaller page_id.

    Only ids, lengths and digests are grouped; equal payloads are combined before the shuffle.
    """
    known = rows.where(F.length("payload") >= min_bytes).select("page_id", "digest")
    first = known.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").drop("n")
    repeats = known.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return repeats.groupBy("page_id", "digest").agg(F.min("refers_to").alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, id_column: str = "page_id", payload_column: str = "html",
               url_column: str = "url", min_revisit_bytes: int = 0, level: int = 6,
               roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all rows as records below ``folder``; lazily returns the files written."""
    ship()
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    found = revisits(rows, min_revisit_bytes).select(F.col("page_id").alias("i"), F.col("digest").alias("d"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d"))
    rows = rows.join(found, same, "left")
    rows = rows.select("page_id", "url", "payload", "refers_to", F.col("d").isNotNull().alias("is_revisit"))
    return rows.mapInArrow(_writer(folder, level, roll_bytes), WRITTEN)


def read_warc(written: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """The records of all files that ``written`` (a stored table) lists, a task for each file."""
    ship()
    tasks = max(1, written.count())
    schema = RECORDS + (", payload binary" if keep_payload else "")
    return written.select("path").repartition(tasks).mapInArrow(_reader(folder, keep_payload), schema)


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.path("archives")
    return read_warc(scratch.keep(write_warc(pages, folder, **options), "written"), folder)
