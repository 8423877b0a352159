"""WARC archives: one gzip member per record, written by tasks and read by a sequential reader.

The reader inflates a file in small pieces, frames each record by its Content-Length, and verifies the block and
payload digests. Payloads that were seen before are revisit records, which hold the response's header alone; its own
Content-Length and the payload digest still tell the size and digest of the whole payload.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import few, n_partitions, shared_dir, small_batches, written

#: Payloads shorter than this are always stored.
LEAST_REVISIT = 100
#: A task begins another file after about so many bytes.
FILE_BYTES = 64 << 20
PIECE = 1 << 16
#: Repeated payloads whose digests are broadcast: 64 characters and a number each, about 50 MB.
FEW = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


class BadRecord(ValueError):
    """A record that is cut off, wrongly framed or doesn't match its digest."""


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One gzip member: a response, or a revisit of the response of page refers_to."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": f"<urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": "".join(c if c.isprintable() and c != " " else "%20" for c in url or ""),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(text.encode() + block + b"\r\n\r\n") + deflate.flush()


class Member:
    """The bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, source, held: bytes):
        self.source, self.inflate, self.ready, self.held = source, zlib.decompressobj(31), bytearray(), held

    def more(self) -> bool:
        """Inflates another piece; false at the member's end."""
        while not self.inflate.eof:
            piece = self.held or self.source.read(PIECE)
            got = self.inflate.decompress(piece, PIECE)
            self.held = self.inflate.unconsumed_tail
            if got:
                self.ready += got
                return True
            if not piece and not self.inflate.eof:
                raise BadRecord("the file ends within a record")
        return False

    def line(self) -> bytes:
        while (at := self.ready.find(b"\r\n")) < 0:
            if not self.more():
                raise BadRecord("a header without end")
        out = bytes(self.ready[:at])
        del self.ready[: at + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self.more():
                raise BadRecord("a block shorter than its Content-Length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def rest(self) -> bytes:
        """What follows the member in the file, as far as it has been read."""
        if self.ready or self.more():
            raise BadRecord("bytes after the record's end")
        return self.inflate.unused_data


def _fields(member: Member) -> dict[str, str]:
    out = {}
    while line := member.line():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_records(source) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(fields, HTTP fields, payload) of each record of an open file, in order. Raises BadRecord."""
    held = b""
    while held or (held := source.read(PIECE)):
        member = Member(source, held)
        if not member.line().startswith(b"WARC/"):
            raise BadRecord("no WARC version line")
        fields = _fields(member)
        block = member.take(int(fields["content-length"]))
        if member.take(4) != b"\r\n\r\n":
            raise BadRecord("a block longer than its Content-Length")
        held = member.rest()
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise BadRecord(f"{fields.get('warc-record-id')}: block digest")
        head, _, payload = block.partition(b"\r\n\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
        if fields.get("warc-type") == "response":
            if int(http.get("content-length", len(payload))) != len(payload):
                raise BadRecord(f"{fields.get('warc-record-id')}: payload length")
            if fields.get("warc-payload-digest", "") != f"sha256:{hashlib.sha256(payload).hexdigest()}":
                raise BadRecord(f"{fields.get('warc-record-id')}: payload digest")
        yield fields, http, payload


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """A folder or file of the shared store, for tasks: local paths and whatever pyarrow's file systems reach, by the names that Spark has for them too."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    known = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gcs": "gs"}.get(parts.scheme, parts.scheme)
    return pafs.FileSystem.from_uri(uri.replace(f"{parts.scheme}:", f"{known}:", 1))


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages (page_id, url, html) with digest and refers_to: the page that holds the same payload, for the others.

    The first page of each repeated payload is found from digests and ids alone; a very common payload is a partial aggregate. Where
    no more than FEW payloads repeat, their digests are broadcast and no payload is shuffled. Where more do, payloads are shuffled by
    digest, once; both sides of that join are plain exchanges, so a payload that many pages hold is split over tasks. A repeated
    row is stored again: rows with the smallest id are all responses. Rows without an id refer to others but are referred to by none.
    """
    body = F.coalesce("html", F.lit(""))
    marks = pages.select("page_id", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("bytes")).where(F.col("bytes") >= least)
    first = marks.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("known"), "first")
    first = few(written(first, "first"), FEW)
    out = pages.select("page_id", "url", body.alias("html"), F.sha2(body, 256).alias("digest"))
    out = out.join(first, out.digest == first.known, "left")
    return out.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html, digest, refers_to) as .warc.gz files in folder; (file), their addresses.

    A file gets its name only when it is whole, under the name of its task and of the attempt, as the rows of another
    attempt may come in another order. The rows returned are those of the attempts that Spark took, so no page is there
    twice or missing, also where a task ran again or beside itself; files of other attempts may lie in folder, unlisted.
    """
    small_batches(pages.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        task, done, out, part_name = TaskContext.get(), [], None, ""
        part = f"part-{task.partitionId():06d}-{task.taskAttemptId():08d}"

        def close() -> None:
            out.close()
            name = f"{part}-{len(done):04d}.warc.gz"
            store.move(part_name, f"{root}/{name}")
            done.append(name)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    part_name = f"{root}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(part_name, compression=None)
                out.write(record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"]))
                if out.tell() >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}" for name in done], pa.string())], names=["file"])

    return written(pages.mapInArrow(run, "file string"), "archives")


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return int(name) if name.lstrip("-").isdigit() else None


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of files (file): page_id, payload_bytes, payload_digest, record_type, refers_to and payload.

    payload_bytes and payload_digest are those of the whole payload for revisits too. payload is null for revisits and
    where it isn't asked for. A record that can't be read or verified raises BadRecord.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = _open(file)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for fields, http, payload in read_records(source):
                        again = fields["warc-type"] == "revisit"
                        rows.append((_page(fields["warc-record-id"]), int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"], _page(fields["warc-refers-to"]) if again else None, payload if with_payload and not again else None))
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 1000 or held > 16 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    listed = files.select("file").repartition(n_partitions(files.sparkSession, 8), "file")
    return listed.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None, with_payload: bool = False) -> DataFrame:
    """Writes pages (page_id, url, html) as archives and reads them back: one row per page.

    folder defaults to a new one in the shared folder. A null html is an empty payload; equal payloads of fewer than
    100 bytes are all responses. An empty table gives no file and no row. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(with_revisits(pages), folder.rstrip("/")), with_payload)
