"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing. Of records with equal payloads the one with the smallest key is stored as a response, the others as revisits
that name it. Only keys and digests are grouped. Each task trains a dictionary on the first records it gets, and its
frames go out through the engine's own text writer as raw bytes, so an archive is written wherever the engine can
write, with its commit protocol. That writer puts a separator behind every row; the separator is an empty skippable
frame, which decoders pass over.

Reading. Archives come through the engine's binary file source. The frame structure is walked by block headers, the
dictionary (plain or itself compressed) is loaded from the leading skippable frame, and each frame is decoded alone and
must hold exactly one record: version line, mandatory headers, a block of the stated length, two line ends. A
response's payload must have the stated length and digest. A task holds one archive and one record at a time.

Defined results: a row without a key is written with an empty record ID and read back so; it revisits the smallest key of
its payload, and is a response where no equal payload has a key; a null payload is written as an empty one; records with equal keys and payloads are all responses if
the key is the smallest; payloads under ``min_bytes`` are never revisits; a null URL is left out, and control
characters in URLs are escaped; an empty table gives an archive without records, or none; extra columns are left out.
A fault in an archive raises ValueError, or with ``on_error="report"`` gives a row with the path, the place and the fault.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the two formats.
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
WARC_DICTIONARY = 0x184D2A5D
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# An empty skippable frame, in bytes that are all ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE[0], 0).decode("ascii")
DATE = "2020-01-01T00:00:00Z"
LEVEL = 3
DICTIONARY_BYTES = 16 << 10
TRAINING_RECORDS = 200
TRAINING_BYTES = 1 << 20


def digest_of(payload: bytes) -> str:
    """The bare SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# ---- writing -----------------------------------------------------------------------


def make_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = "" if key is None else key
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("Content-Length", str(len(block))),
    ]
    if url is not None:
        safe = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8", "replace")), url)
        headers.insert(2, ("WARC-Target-URI", safe))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"WARC/1.1\r\n" + b"".join(f"{n}: {v}\r\n".encode() for n, v in headers)
    return head + b"\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records; none where they are too few or too small to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records) if len(records) >= 8 else None
    except zstandard.ZstdError:
        return None


def frames(records: Iterator[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The frames of one archive: the dictionary, then one frame per record."""
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if len(first) == TRAINING_RECORDS or size >= TRAINING_BYTES:
            break
    if not first:
        return
    dictionary = train(first)
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        yield struct.pack("<II", WARC_DICTIONARY, len(packed)) + packed
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)
    yield from map(compressor.compress, chain(first, records))


def with_revisits(pages: DataFrame, key: str, payload: str, url: str, min_bytes: int) -> DataFrame:
    """``key, url, payload, refers_to``: the smallest key with an equal payload, null for that one itself. A row without a
    key refers to that key as well; where no row of a payload has one, there is nothing to refer to."""
    digest = F.sha1("payload")
    keyed = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    shared = (
        keyed.where(F.octet_length("payload") >= min_bytes).groupBy(digest.alias("digest"))
        .agg(F.min("key").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1 and leader is not null").drop("n")
    )
    joined = keyed.withColumn("digest", digest).join(shared, "digest", "left")
    refers = F.when(F.col("key").isNull() | (F.col("key") > F.col("leader")), F.col("leader"))
    return joined.select("key", "url", "payload", refers.alias("refers_to"))


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", payload: str = "html", url: str = "url",
    min_bytes: int = 0, level: int = LEVEL,
) -> None:
    """Write a folder of archives, one per task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            make_record(*row) for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "payload", "refers_to")), strict=True)
        )
        for frame in frames(records, level):
            yield pa.record_batch({"frame": pa.array([frame], pa.binary())})

    rows = with_revisits(pages, key, payload, url, min_bytes)
    rows.mapInArrow(work, "frame binary").select(F.col("frame").cast("string")).write.option(
        "lineSep", SEPARATOR
    ).text(path)


# ---- reading -----------------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and its block headers."""
    flags = data[at + 4]
    single, has_checksum = flags >> 5 & 1, flags >> 2 & 1
    size_bytes = (single, 2, 4, 8)[flags >> 6]
    place = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + size_bytes
    last = 0
    while not last:
        head = int.from_bytes(data[place:place + 3], "little")
        if place + 3 > len(data):
            raise ValueError("the frame is cut off")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise ValueError("the frame has a block of an unknown kind")
        place += 3 + (1 if kind == 1 else size)
    place += 4 * has_checksum
    if place > len(data):
        raise ValueError("the frame is cut off")
    return place


@dataclass(frozen=True)
class Record:
    offset: int
    headers: dict[str, bytes]
    block: bytes

    def payload(self) -> bytes:
        """What follows the HTTP headers of the block."""
        return self.block.partition(b"\r\n\r\n")[2]


def parse_record(data: bytes, offset: int) -> Record:
    """Check and take apart the one record of a frame."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in VERSIONS:
        raise ValueError("the frame does not start with a WARC version line and headers")
    headers: dict[str, bytes] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and name:
            headers[name] += b" " + line.strip()
            continue
        left, colon, value = line.partition(b":")
        name = left.decode("latin-1").lower()
        if not colon or not name or name != name.strip():
            raise ValueError("a header line has no name")
        headers[name] = value.strip()
    missing = [n for n in MANDATORY if n not in headers]
    if missing:
        raise ValueError(f"headers are missing: {', '.join(missing)}")
    if not headers["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block has not the stated length, or the frame holds more than one record")
    return Record(offset, headers, rest[:length])


def read_archive(content: bytes) -> Iterator[Record]:
    """The records of one archive; ValueError, with the offset, at the first fault."""
    data, at, dictionary = memoryview(content), 0, None
    decoder = zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            if at + 8 > len(data):
                raise ValueError("the frame is cut off")
            magic, size = struct.unpack_from("<II", data, at)
            if magic in SKIPPABLE:
                if at + 8 + size > len(data):
                    raise ValueError("the frame is cut off")
                if magic == WARC_DICTIONARY and at == 0:
                    raw = bytes(data[8:8 + size])
                    if raw[:4] == struct.pack("<I", FRAME):
                        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                    if raw[:4] != struct.pack("<I", DICTIONARY):
                        raise ValueError("the leading frame holds no dictionary")
                    dictionary = zstandard.ZstdCompressionDict(raw)
                    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
                at += 8 + size
                continue
            if magic != FRAME:
                raise ValueError("this is no Zstandard frame")
            end = frame_end(data, at)
            record = parse_record(decoder.decompressobj().decompress(data[at:end]), at)
        except (ValueError, IndexError, zstandard.ZstdError) as fault:
            raise ValueError(f"at byte {at}: {fault}") from fault
        yield record
        at = end


def describe(record: Record) -> tuple:
    """A record as a row; checks a response's payload against the stated length and digest."""
    headers, payload = record.headers, record.payload()
    kind = headers["warc-type"].decode("latin-1")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", record.block.partition(b"\r\n\r\n")[0])
    size = int(stated.group(1)) if stated else len(payload)
    digest = headers.get("warc-payload-digest", b"").removeprefix(b"sha1:").decode("latin-1")
    if kind == "response":
        if size != len(payload):
            raise ValueError(f"at byte {record.offset}: the payload has not the stated length")
        if digest and digest != digest_of(payload):
            raise ValueError(f"at byte {record.offset}: the payload has not the stated digest")
        digest = digest or digest_of(payload)
    text = lambda name: headers[name].decode("utf-8", "replace") if name in headers else None
    return (
        record.offset, kind, text("warc-record-id"), text("warc-target-uri"), text("warc-date"),
        text("warc-refers-to"), size, digest, payload if kind == "response" else None,
    )


COLUMNS = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
])
SCHEMA = (
    "path string, offset bigint, record_type string, record_id string, target_uri string, date string, "
    "refers_to string, payload_bytes bigint, payload_digest string, payload binary, error string"
)
ROWS_AT_ONCE = 256


def read_warc(spark: SparkSession, path: str, on_error: str = "raise", payloads: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``."""
    if on_error not in ("raise", "report"):
        raise ValueError(f"unknown on_error: {on_error!r}")

    def rows(name: str, content: bytes) -> Iterator[tuple]:
        try:
            for record in read_archive(content):
                row = describe(record)
                yield (name, *(row if payloads else (*row[:-1], None)), None)
        except ValueError as fault:
            if on_error == "raise":
                raise ValueError(f"{name}: {fault}") from fault
            place = re.match(r"at byte (\d+)", str(fault))
            yield (name, int(place.group(1)) if place else None, *[None] * 8, str(fault))

    def pack(block: list[tuple]) -> pa.RecordBatch:
        columns = zip(*block, strict=True)
        return pa.record_batch([pa.array(v, f.type) for v, f in zip(columns, COLUMNS, strict=True)], schema=COLUMNS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                block = []
                for row in rows(name.as_py(), content.as_py()):
                    block.append(row)
                    if len(block) == ROWS_AT_ONCE:
                        yield pack(block)
                        block = []
                if block:
                    yield pack(block)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(work, SCHEMA)
