"""Web pages to WARC archives and back, as a table of chunks.

A payload travels as rows of (record, chunk number, bytes), never as one value on
the Python side: the writer compresses and digests chunk by chunk, the reader hands
out the same kind of rows with the digest up to each. Every record is a gzip
member of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import fresh_path, written_table

CHUNK_BYTES = 1 << 20
# An archive file is closed once it holds so many bytes, and is read back by one task.
FILE_BYTES = 32 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 16


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, sha1, record_type, refers_to`` of every page.

    Of equal payloads of at least ``least_bytes`` the one with the smallest
    page_id is a response, rows that share that page_id too; the others, null ids
    among them, revisit it. Payloads with null ids only are all responses. A
    null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1")
    )
    owners = (
        rows.groupBy("sha1", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("owner"))
        .where((F.col("n") > 1) & (F.col("payload_bytes") >= least_bytes) & F.col("owner").isNotNull())
        .select("sha1", "payload_bytes", "owner")
    )
    joined = lookup_join(rows, written_table(owners, "warc-owners"), ["sha1", "payload_bytes"])
    again = F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("page_id"))
    return joined.select(
        *("page_id", "url", "payload", "payload_bytes", "sha1"),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("owner")).alias("refers_to"),
    )


def chunk_table(found: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records as rows of chunks, in order and side by side; a revisit has one chunk without bytes."""
    last = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(
        F.greatest(F.ceil(F.col("payload_bytes") / F.lit(chunk_bytes)).cast("int") - 1, F.lit(0))
    )
    number = F.col("chunk_no")
    chunk = F.when(
        F.col("record_type") == "response",
        F.substring(F.col("payload"), number * F.lit(chunk_bytes) + F.lit(1), F.lit(chunk_bytes)),
    ).otherwise(F.lit(b""))
    return found.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"), last.alias("last_chunk")).select(
        "page_id", "url", "payload_bytes", "sha1", "record_type", "refers_to", "chunk_no", "last_chunk", chunk.alias("chunk")
    )


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(urn: str) -> int | None:
    text = urn.strip("<>").split(":")[2]
    return int(text) if text else None


def heads(page_id, url, size: int, digest: str, kind: str, refers_to) -> bytes:
    """The WARC header of a record and the HTTP header its block begins with."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        fields += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    fields.append(f"Content-Length: {len(http) + (0 if kind == 'revisit' else size)}")
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http


class Archive:
    """One archive file being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.file, self.records = system.open_output_stream(path, compression=None), 0
        info = b"software: chunked record table\r\n"
        self.begin(
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode()
        )
        self.add(info)
        self.finish()

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, piece: bytes) -> None:
        self.file.write(self.member.compress(piece))

    def finish(self) -> None:
        self.file.write(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        size = self.file.tell()
        self.file.close()
        return self.path, self.records, size


def writing(folder: str):
    """Write chunk rows to archives below ``folder``; the rows that come out name the finished files."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, digest, done = None, None, []
        for batch in batches:
            names = ("page_id", "url", "payload_bytes", "sha1", "record_type", "refers_to", "chunk_no", "last_chunk", "chunk")
            columns = [batch.column(name) for name in names]
            for at in range(batch.num_rows):
                page_id, url, size, sha1, kind, refers_to, number, last, chunk = (c[at].as_py() for c in columns)
                if number == 0:
                    if archive is not None and archive.file.tell() >= FILE_BYTES:
                        done.append(archive.close())
                        archive = None
                    archive = archive or Archive(folder)
                    archive.begin(heads(page_id, url, size, base32(sha1), kind, refers_to))
                    digest = hashlib.sha1()
                archive.add(chunk)
                digest.update(chunk)
                if number == last:
                    archive.finish()
                    if kind == "response" and digest.hexdigest() != sha1:
                        raise ValueError(f"chunks of page {page_id} do not make up its payload")
        if archive is not None:
            done.append(archive.close())
        columns = list(zip(*done)) or [(), (), ()]
        types = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "records", "bytes"])

    return written


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Archives of all ``pages`` (``page_id, url, html``) and the list of their files: ``path, records, bytes``.

    Files get fresh names and count only when listed, and the list is written by
    Spark: files of failed or repeated tasks are never listed. ``folder`` must
    be reachable by every executor; the default, for archives read back at
    once, is a scratch folder in the shared one. Repeated rows get a record each, an empty table no file.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    rows = chunk_table(records(pages, least_bytes), chunk_bytes)
    return written_table(rows.mapInArrow(writing(folder), "path string, records long, bytes long"), "warc-files")


class Reader:
    """Bytes of an archive file, decompressed as they are asked for."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_stream(place, compression=None)
        self.member, self.held, self.raw = zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.file.read(_READ)
                if not self.raw:
                    return False
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            # At most a megabyte comes out at a time, however well the input is compressed.
            out = self.member.decompress(self.raw, CHUNK_BYTES)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if out:
                self.held += out
                return True

    def head(self) -> dict[str, str] | None:
        """The next block of header lines; None at the end of the file."""
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        lines = self.held[:end].decode("utf-8", "surrogatepass").lstrip("\r\n").split("\r\n")
        self.held = self.held[end + 4 :]
        return {"": lines[0]} | {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}

    def pieces(self, size: int, most: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces of ``most``, the last one shorter."""
        while size > 0:
            want = min(size, most)
            while len(self.held) < want:
                if not self.more():
                    raise ValueError("the archive ends inside a record")
            piece, self.held = self.held[:want], self.held[want:]
            size -= want
            yield piece


CHUNKS = (
    "page_id long, record_type string, target_uri string, refers_to long, declared_digest string, "
    "chunk_no int, payload_offset long, chunk_bytes long, payload_bytes long, digest string, last boolean, chunk binary"
)


def file_chunks(path: str, chunk_bytes: int) -> Iterator[tuple]:
    """The chunk rows of an archive file, one at a time."""
    reader = Reader(path)
    while (head := reader.head()) is not None:
        left = int(head["content-length"])
        kind = head["warc-type"]
        if kind not in ("response", "revisit"):
            for _ in reader.pieces(left + 4, _READ):
                pass
            continue
        block = reader.held
        http = reader.head()
        # The block's own header has been read; what is left of the block is payload.
        used = _http_size(block, http)
        left -= used
        size = int(http["content-length"])
        declared = head["warc-payload-digest"].removeprefix("sha1:")
        page_id = page_of(head["warc-record-id"])
        refers_to = page_of(head["warc-refers-to"]) if kind == "revisit" else None
        common = (page_id, kind, head.get("warc-target-uri"), refers_to, declared)
        sha1, offset, number = hashlib.sha1(), 0, 0
        for piece in reader.pieces(left, chunk_bytes) if left else iter([b""]):
            sha1.update(piece)
            last = offset + len(piece) == left
            digest = base64.b32encode(sha1.digest()).decode() if kind == "response" else declared
            if last and kind == "response" and (digest != declared or left != size):
                raise ValueError(f"the payload of page {page_id} in {path} is damaged")
            yield (*common, number, offset, len(piece), size, digest, last, piece)
            offset, number = offset + len(piece), number + 1
        for _ in reader.pieces(4, 4):
            pass


def _http_size(block: bytes, http: dict[str, str] | None) -> int:
    """Bytes of an HTTP header as written by ``heads``."""
    if http is None:
        raise ValueError("a record without a header")
    lines = [http[""]] + [f"{name}: {value}" for name, value in http.items() if name]
    return len("\r\n".join(lines).encode("utf-8", "surrogatepass")) + 4


def reading(chunk_bytes: int, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [column.split()[0] for column in CHUNKS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        types += [pa.string(), pa.bool_(), pa.binary()]

        def rows(held):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in file_chunks(path, chunk_bytes):
                    held.append(row if with_payload else (*row[:-1], None))
                    size += len(row[-1]) if with_payload else 0
                    if size >= 8 * CHUNK_BYTES or len(held) >= 5000:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    return read


def read_chunks(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the listed archives as rows of chunks, a task per file.

    ``digest`` is the base32 SHA-1 of the payload up to and including the
    chunk; the last one is held against the declared digest and length, and a
    damaged record fails the job. A revisit gives one row without bytes, with
    the length and digest it declares. Without ``with_payload`` the bytes are
    read and digested, but ``chunk`` is null.
    """
    count = max(1, files.count())
    # By range, as hashes would send several files to one task and none to others.
    paths = files.select("path").repartitionByRange(count, "path")
    return paths.mapInArrow(reading(chunk_bytes, with_payload), CHUNKS)
