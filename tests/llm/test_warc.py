"""Archives: round trips, the layout on disk, and every fault that the reader must find."""

import base64
import glob
import hashlib
import struct

import pytest
import zstandard

from kempt.llm import warc
from kempt.llm.queries import QUERIES

ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, None, None), (3, "http://a/3", "<p>one</p>"), (4, "x y\r\nz: é", ""),
    (5, "u", "é😀\r\n\r\n" * 50), (6, "u", "long " * 200_000), (7, "u", "<p>one</p>"),
] + [(100 + i, f"http://b/{i}", f"<html>page {i % 40} of many</html>" * 20) for i in range(120)]


def brute(rows):
    first = {}
    for key, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", key)
    return {
        (key, len((html or "").encode()), base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode(),
         "response" if first[html or ""] == key else "revisit", None if first[html or ""] == key else first[html or ""])
        for key, _, html in rows
    }


@pytest.fixture
def archive(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").selectExpr("*", "1 as payload", "2 as digest")
    path = str(tmp_path / "out")
    warc.write_warc(df.repartition(3), path)
    return path


def test_round_trip(spark, archive):
    rows = warc.read_warc(spark, archive).collect()
    number = lambda name: name and int(name.removeprefix("<urn:page:").removesuffix(">"))
    assert {(number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in rows} == brute(ROWS)
    assert len(rows) == len(ROWS) and all(r["error"] is None for r in rows)
    given = {k: (h or "").encode() for k, _, h in ROWS}
    assert all(bytes(r["payload"]) == given[number(r["record_id"])] for r in rows if r["record_type"] == "response")
    uri = {number(r["record_id"]): r["target_uri"] for r in rows}
    assert uri[4] == "x%20y%0D%0Az:%20%C3%A9" and uri[2] is None


def test_layout_on_disk(archive):
    records = 0
    for name in glob.glob(archive + "/part-*"):
        data = open(name, "rb").read()
        found = list(warc.read_archive(data))
        records += len(found)
        if len(found) >= 8:
            assert struct.unpack_from("<I", data)[0] == 0x184D2A5D
    assert records == len(ROWS)


def frames_of(records, level=3):
    return list(warc.frames(iter(records), level))


def sample(n=30):
    return [warc.make_record(i, "http://x", b"<p>payload %d</p>" % i * 9, None) for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_plain_and_compressed_dictionaries(packed):
    frames = frames_of(sample())
    raw = zstandard.ZstdDecompressor().decompress(frames[0][8:])
    if not packed:
        frames[0] = struct.pack("<II", 0x184D2A5D, len(raw)) + raw
    assert len(list(warc.read_archive(b"".join(frames)))) == 30


def test_frames_without_content_size_and_other_skippable_frames():
    pack = zstandard.ZstdCompressor(write_content_size=False).compressobj
    data = b""
    for record in sample(3):
        one = pack()
        data += one.compress(record) + one.flush() + struct.pack("<II", 0x184D2A53, 5) + b"extra"
    assert len(list(warc.read_archive(data))) == 3 and list(warc.read_archive(b"")) == []


RECORD = warc.make_record(1, "u", b"abc", None)
COMPRESS = zstandard.ZstdCompressor().compress


@pytest.mark.parametrize("data, fault", [
    (COMPRESS(RECORD)[:-3], "cut off"), (COMPRESS(RECORD) + b"abc", "cut off"), (b"garbage bytes", "no Zstandard"),
    (COMPRESS(RECORD + RECORD), "more than one record"), (COMPRESS(RECORD[:-2]), "stated length"),
    (COMPRESS(RECORD.replace(b"WARC/1.1", b"WARC/9.9")), "version line"), (COMPRESS(b""), "version line"),
    (COMPRESS(RECORD.replace(b"WARC-Date: ", b"X-Date: ")), "missing: warc-date"),
    (COMPRESS(RECORD.replace(b"WARC-Date: ", b"WARC-Date ")), "no name|missing"),
    (COMPRESS(RECORD.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: x", 1)), "no number"),
    (struct.pack("<II", 0x184D2A5D, 4) + b"none", "no dictionary"), (struct.pack("<II", 0x184D2A50, 99), "cut off"),
])
def test_faults(data, fault):
    with pytest.raises(ValueError, match=fault):
        list(warc.read_archive(data))


@pytest.mark.parametrize("old, new", [(b"abc\r\n", b"abd\r\n"), (b"Content-Length: 3", b"Content-Length: 4")])
def test_payload_checks(old, new):
    with pytest.raises(ValueError, match="stated"):
        [warc.describe(r) for r in warc.read_archive(COMPRESS(RECORD.replace(old, new)))]


def test_reported_faults(spark, tmp_path):
    (tmp_path / "bad").write_bytes(COMPRESS(RECORD) + b"oops, no frame")
    rows = warc.read_warc(spark, str(tmp_path / "bad"), on_error="report").orderBy("offset").collect()
    assert [r["error"] is None for r in rows] == [True, False] and "no Zstandard" in rows[1]["error"]
    with pytest.raises(Exception, match="no Zstandard"):
        warc.read_warc(spark, str(tmp_path / "bad")).collect()


def test_small_payloads_may_stay_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id bigint, url string, html string")
    warc.write_warc(df, str(tmp_path / "o"), min_bytes=3)
    assert {r["record_type"] for r in warc.read_warc(spark, str(tmp_path / "o")).collect()} == {"response"}


def test_empty_table(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "o"))
    assert warc.read_warc(spark, str(tmp_path / "o")).collect() == []


def test_query_over_the_whole_table(spark, folder):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert {tuple(r) for r in QUERIES["op1_warc"](spark, folder).collect()} == brute(rows)


def test_rows_without_a_key(spark, tmp_path):
    pages = [(None, "u", "<p>a</p>"), (3, "u", "<p>a</p>"), (7, None, "<p>a</p>"), (None, "u", "<p>a</p>"), (None, "u", "b"), (None, "u", "b"), (None, None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    rows = QUERIES["op1_warc"](spark, str(tmp_path)).collect()
    order = lambda r: tuple(x or 0 for x in r)
    assert sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows), key=order) == sorted([
        (0, "revisit", 3, 8), (3, "response", None, 8), (7, "revisit", 3, 8), (0, "revisit", 3, 8), (0, "response", None, 1),
        (0, "response", None, 1), (0, "response", None, 0),
    ], key=order)
