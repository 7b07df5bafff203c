"""Archives of web records (WARC 1.1) under Zstandard, with a dictionary in front.

An archive begins with a skippable frame that holds the dictionary; every record follows as a frame of its own. Each
task writes archives of its own rows and trains the dictionary on its first records. The reader streams an archive:
dictionary, then frame by frame, one record each, checking magic numbers, header lines, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.files import attempt_name, new_folder, open_input, open_output
from cohortloom.llm.text import bounded_batches
from cohortloom.runtime import materialize

# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
TRAIN_RECORDS = 256
TRAIN_BYTES = 4 << 20
READ_BYTES = 256 << 10
READ_TASKS = 100_000
DATE = "2000-01-01T00:00:00Z"


class ArchiveError(ValueError):
    """An archive that does not hold what its headers say."""


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    @property
    def payload(self) -> bytes:
        """The body of a captured response, or the whole block of any other record."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


def sha1_label(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str) -> str:
    """A record's address, from the key of the page."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}')}>"


def serialise(headers: Sequence[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{sha1_label(block)}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Record:
    """One record from the content of one frame; raises on anything that does not add up."""
    if not data.startswith(VERSION):
        raise ArchiveError(f"no record begins with {data[:20]!r}")
    head, gap, rest = data[len(VERSION) :].partition(b"\r\n\r\n")
    if not gap:
        raise ArchiveError("the header does not end")
    headers: dict[str, str] = {}
    try:
        lines = head.decode("utf-8").split("\r\n")
    except UnicodeDecodeError as e:
        raise ArchiveError("a header that is not UTF-8") from e
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise ArchiveError(f"malformed header line {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"a record lacks {name}")
    if not headers["content-length"].isdigit():
        raise ArchiveError(f"content length {headers['content-length']!r}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"a block of {len(rest) - 4} bytes is declared as {length}")
    record = Record(headers, rest[:length])
    if (said := headers.get("warc-block-digest")) and said != f"sha1:{sha1_label(record.block)}":
        raise ArchiveError("block digest differs")
    if record.kind == "response" and (said := headers.get("warc-payload-digest")):
        if said != f"sha1:{sha1_label(record.payload)}":
            raise ArchiveError("payload digest differs")
    return record


def train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary, or none where there is too little to learn from."""
    if len(samples) < 8 or sum(map(len, samples)) < 8 * size:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes a dictionary frame, if there is a dictionary, and one frame per record."""

    def __init__(self, out: BinaryIO, dictionary: zstandard.ZstdCompressionDict | None, level: int = 3):
        self.out, self.size = out, 0
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
        if dictionary:
            content = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


def _exactly(source: BinaryIO, n: int) -> bytes:
    data = source.read(n)
    if len(data) != n:
        raise ArchiveError("the archive ends inside the dictionary")
    return data


def read_frames(source: BinaryIO) -> Iterator[bytes]:
    """The content of each frame of an archive; the leading skippable frame supplies the dictionary.

    The dictionary may itself be a Zstandard frame. Other skippable frames are passed over.
    """
    start = source.read(4)
    dictionary, pending = None, start
    if len(start) == 4 and struct.unpack("<I", start)[0] == DICTIONARY_FRAME:
        content = _exactly(source, struct.unpack("<I", _exactly(source, 4))[0])
        if content[:4] == struct.pack("<I", FRAME):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        if content[:4] != struct.pack("<I", DICTIONARY):
            raise ArchiveError("the leading frame holds no dictionary")
        dictionary, pending = zstandard.ZstdCompressionDict(content), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        while len(pending) < 8 and (more := source.read(READ_BYTES)):
            pending += more
        if not pending:
            return
        if len(pending) < 8:
            raise ArchiveError("stray bytes at the end")
        magic, size = struct.unpack("<II", pending[:8])
        if magic >> 4 == 0x184D2A5:
            while len(pending) < size + 8 and (more := source.read(READ_BYTES)):
                pending += more
            if len(pending) < size + 8:
                raise ArchiveError("a skippable frame ends early")
            pending = pending[size + 8 :]
            continue
        if magic != FRAME:
            raise ArchiveError(f"no frame begins with {pending[:4]!r}")
        frame, parts = decompressor.decompressobj(), []
        try:
            while True:
                parts.append(frame.decompress(pending))
                if frame.eof:
                    break
                if not (pending := source.read(READ_BYTES)):
                    raise ArchiveError("a frame ends early")
        except zstandard.ZstdError as e:
            raise ArchiveError(f"a frame is damaged: {e}") from e
        pending = frame.unused_data
        yield b"".join(parts)


def read_records(source: BinaryIO) -> Iterator[Record]:
    for content in read_frames(source):
        yield parse(content)


def _page_record(row: dict) -> bytes:
    """A response with its payload, or a revisit of an equal one; keys are texts, null for unknown."""
    payload = row["payload"]
    headers = [
        ("WARC-Type", "revisit" if row["refers_to"] is not None else "response"),
        ("WARC-Record-ID", record_id(row["key"]) if row["key"] is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
    ]
    if row["uri"]:
        headers.append(("WARC-Target-URI", quote(row["uri"], safe="%/:=&?~#+!$,;'@()*[]")))
    headers.append(("WARC-Payload-Digest", f"sha1:{sha1_label(payload)}"))
    if row["key"] is not None:
        headers.append(("Page-Key", quote(row["key"], safe="")))
    if row["refers_to"] is not None:
        headers += [
            ("WARC-Refers-To", record_id(row["refers_to"])),
            ("Refers-To-Page-Key", quote(row["refers_to"], safe="")),
            ("WARC-Profile", REVISIT_PROFILE),
        ]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return serialise(headers, http if row["refers_to"] is not None else http + payload)


def write_archives(
    pages: DataFrame,
    key_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per row and return the written list of archives (``path``, ``records``, ``bytes``).

    Of the rows with equal payloads of at least ``revisit_bytes`` bytes, the one with the largest key is a response and
    the others are revisits without payload that refer to it; rows that repeat the largest key are responses, too. A
    null payload is empty. A null key never is the largest; where a group has no other, all its rows are responses. A
    null or empty address is left out. An empty table gives an empty list.

    The largest keys are found by a grouped maximum over digests, of which only groups with several rows are kept, so
    payloads travel only if that list is too large to broadcast. Every attempt of a task writes files of its own, and
    only the files in the returned list count.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = new_folder(spark, "archives")
    plain = pages.select(
        F.col(key_col).alias("key"),
        F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    shared = materialize(
        plain.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and response is not null")
        .select("digest", "response"),
        "shared",
    )
    ready = plain.join(shared, "digest", "left").select(
        F.col("key").cast("string").alias("key"),
        "uri",
        "payload",
        F.when(F.col("key").isNull() | (F.col("key") != F.col("response")), F.col("response").cast("string")).alias("refers_to"),
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        first: list[bytes] = []
        size = 0
        for row in rows:
            first.append(_page_record(row))
            size += len(first[-1])
            if len(first) >= TRAIN_RECORDS or size >= TRAIN_BYTES:
                break
        if not first:
            return
        dictionary = train(first, DICTIONARY_BYTES)
        writer, path, records = None, "", 0

        def closed() -> pa.RecordBatch:
            writer.out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": records, "bytes": writer.size}])

        def all_records() -> Iterator[bytes]:
            yield from first
            first.clear()
            for row in rows:
                yield _page_record(row)

        for record in all_records():
            if writer is not None and writer.size >= archive_bytes:
                yield closed()
                writer = None
            if writer is None:
                path, records = attempt_name(folder, "pages", ".warc.zst"), 0
                writer = ArchiveWriter(open_output(path), dictionary)
            writer.add(record)
            records += 1
        yield closed()

    return materialize(ready.mapInArrow(written, "path string, records long, bytes long"), "archives")


RECORD = (
    "path string, record long, record_type string, record_id string, uri string, date string, page_key string, "
    "refers_to_key string, refers_to string, payload_digest string, payload binary"
)
_RECORD_TYPE = pa.schema(
    [(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in RECORD.split(", ")]
)


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Every record of the archives named in ``archives.path``, in one task per archive and a frame at a time.

    A damaged archive raises :class:`ArchiveError`. An archive without the dictionary frame is read without one; an
    empty file has no records. Absent headers are null.
    """
    tasks = max(1, min(READ_TASKS, archives.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with open_input(path) as source:
                    for number, record in enumerate(read_records(io.BufferedReader(source, READ_BYTES))):
                        rows.append(_row(path, number, record))
                        size += len(record.block) + 200
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD_TYPE)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD_TYPE)

    return archives.select("path").repartition(tasks).mapInArrow(read, RECORD)


def _row(path: str, number: int, record: Record) -> dict:
    h = record.headers
    digest = h.get("warc-payload-digest")
    return {
        "path": path,
        "record": number,
        "record_type": record.kind,
        "record_id": h["warc-record-id"],
        "uri": h.get("warc-target-uri"),
        "date": h["warc-date"],
        "page_key": _unquoted(h.get("page-key")),
        "refers_to_key": _unquoted(h.get("refers-to-page-key")),
        "refers_to": h.get("warc-refers-to"),
        "payload_digest": digest.removeprefix("sha1:") if digest else None,
        "payload": None if record.kind == "revisit" else record.payload,
    }


def _unquoted(value: str | None) -> str | None:
    return None if value is None else unquote(value)
