import io
import struct

import zstandard

from velograph.llm.common import Workspace, file_system
from velograph.llm.warc import (
    DICTIONARY_MAGIC,
    dictionary_frame,
    payload_digest,
    read_archives,
    read_records,
    record_bytes,
    train_dictionary,
    write_archives,
)

PAGES = [
    (1, "http://a/1", "<p>same</p>", "x"),
    (2, "http://a/2", "<p>same</p>", "x"),
    (3, None, "<p>other é</p>\r\n\r\n", "x"),
    (4, "http://a/\r\nX-Page-Id: 9", "", "x"),
    (5, "http://a/5", None, "x"),
    (5, "http://a/5", None, "x"),
    (None, "http://a/6", "<p>same</p>", "x"),
    (None, "http://a/7", "no id at all", "x"),
    (8, "http://a/8", "long " * 50_000, "x"),
]
SCHEMA = "page_id BIGINT, url STRING, html STRING, digest STRING"


def test_records_come_back(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    archives = write_archives(pages, Workspace(spark), archive_bytes=300)
    assert archives.count() > 1
    rows = read_archives(archives, with_payload=True).collect()
    assert len(rows) == len(PAGES)
    found = {(r["page_id"], r["url"]): r for r in rows}
    assert found[2, "http://a/2"]["record_type"] == "response"
    assert (found[1, "http://a/1"]["record_type"], found[1, "http://a/1"]["refers_to"]) == ("revisit", 2)
    assert found[None, "http://a/6"]["refers_to"] == 2
    assert found[None, "http://a/7"]["record_type"] == "response"
    assert found[3, None]["payload"] == PAGES[2][2].encode()
    assert found[8, "http://a/8"]["payload"] == PAGES[8][2].encode()
    empty = [r for r in rows if r["payload_bytes"] == 0]
    assert sorted(r["record_type"] for r in empty) == ["response", "response", "revisit"]
    assert {r["payload_digest"] for r in empty} == {payload_digest(b"")}
    assert {r["page_id"]: r["refers_to"] for r in empty} == {4: 5, 5: None}


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES[:6], SCHEMA)
    rows = read_archives(write_archives(pages, Workspace(spark), min_bytes=100)).collect()
    assert {r["record_type"] for r in rows} == {"response"}


def stored_bytes(path):
    folder, name = path.rsplit("/", 1)
    system, root = file_system(folder)
    with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
        return stream.read()


def test_files_open_with_the_dictionary_and_at_any_record(spark):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"<p>page {k}</p>" * 50, "x") for k in range(40)], SCHEMA)
    for row in write_archives(pages, Workspace(spark), archive_bytes=2000).collect():
        stored = stored_bytes(row["path"])
        assert len(stored) == row["bytes"]
        magic, size = struct.unpack("<II", stored[:8])
        assert magic == DICTIONARY_MAGIC
        shared, at, found = zstandard.ZstdCompressionDict(stored[8 : 8 + size]), 8 + size, 0
        while at < len(stored):
            unpacker = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
            record = unpacker.decompress(stored[at:])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"</p>\r\n\r\n")
            at, found = len(stored) - len(unpacker.unused_data), found + 1
        assert found == row["records"]


def test_large_pages_share_a_dictionary_too(spark):
    body = "".join(f"<li>{k * k}</li>" for k in range(12_000))
    pages = spark.createDataFrame([(k, None, f"<h1>{k}</h1>{body}", "x") for k in range(4)], SCHEMA)
    archives = write_archives(pages, Workspace(spark)).collect()
    assert all(struct.unpack("<II", stored_bytes(r["path"])[:8])[1] > 0 for r in archives)


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert read_archives(write_archives(pages, Workspace(spark))).count() == 0


def test_each_record_is_a_frame_of_its_own_behind_the_dictionary():
    records = [record_bytes(k, f"http://a/{k}", b"<html>%d</html>" % k, "D", None, False, "") for k in range(200)]
    dictionary = train_dictionary(records, 2048)
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    frames = [packer.compress(r) for r in records]
    stored = dictionary_frame(dictionary) + b"".join(frames)
    assert struct.unpack("<II", stored[:8]) == (DICTIONARY_MAGIC, len(dictionary))
    assert sum(map(len, frames)) < 0.5 * sum(len(zstandard.compress(r)) for r in records)
    assert [int(h["X-Page-Id"]) for h, _ in read_records(io.BytesIO(stored))] == list(range(200))
    # A reader can start at any record.
    later = dictionary_frame(dictionary) + b"".join(frames[150:])
    assert [int(h["X-Page-Id"]) for h, _ in read_records(io.BytesIO(later))] == list(range(150, 200))
