"""WARC archives whose records are zstd frames that share a dictionary.

An archive opens with a skippable frame that holds the dictionary; each record follows as a frame of
its own, so that a reader can start at any record. Pages with equal payloads are archived once: one
of them as a response, the others as revisits that name it. Only digests are grouped; the pages
themselves are written by the tasks that hold them, straight into the folder that all executors
share. The list of archives is written last, by Spark, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator
from uuid import NAMESPACE_URL, uuid4, uuid5

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.common import Workspace, file_system

# Fixed values of the file format: the skippable frame's magic number and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"

# The dictionary is trained on so many records at most, and on so many first bytes of each.
SAMPLE_RECORDS = 500
SAMPLE_RECORD_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
# An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 << 20

_DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstd dictionary from whole records; the records' own bytes if there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def _line(text: str) -> str:
    """A header value: control characters are escaped, so that it stays on its line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record_id(page_id: int | None, row: str) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{page_id}') if page_id is not None else uuid5(NAMESPACE_URL, row)}>"


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, row: str
) -> bytes:
    """One uncompressed record: a response with the payload, or a revisit with its HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, row)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: {_record_id(refers_to, '')}")
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def open_dictionary(stream) -> zstandard.ZstdCompressionDict | None:
    """Read the leading frame; the stream then stands at the first record."""
    start = stream.read(8)
    if len(start) < 8:
        return None
    magic, size = struct.unpack("<II", start)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    return zstandard.ZstdCompressionDict(stream.read(size))


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, one record in memory at a time."""
    dictionary = open_dictionary(stream)
    if dictionary is None:
        return
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(stream, read_across_frames=True)
    lines = io.BufferedReader(reader, buffer_size=1 << 20)
    while line := lines.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin where the one before it ends")
        headers = {}
        while (line := lines.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = lines.read(size)
        if len(block) < size or lines.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, block


def choose_responses(pages: DataFrame, work: Workspace, min_bytes: int) -> DataFrame:
    """``pages`` with payload, digest, refers_to and revisit: the largest id of equal payloads is kept.

    Payloads below ``min_bytes`` are never revisits. Rows that repeat the kept id are kept as well; a
    null id comes after all others, and a group without ids has no revisits.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [payload_digest(p or b"") for p in batch.column("payload").to_pylist()]
            columns = [*batch.columns, pa.array(found, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "payload", "digest"])

    source = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    digested = source.mapInArrow(digests, "page_id BIGINT, url STRING, payload BINARY, digest STRING")
    size = F.octet_length("payload")
    # Written: both sides of the join are then plain exchanges, and one payload's many rows split.
    kept = work.keep(
        digested.where(size >= min_bytes)
        .groupBy("digest", size.alias("size"))
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("copies"))
        .where("copies > 1 AND kept IS NOT NULL")
        .drop("copies")
    )
    joined = digested.withColumn("size", size).join(kept, ["digest", "size"], "left")
    return joined.withColumn("revisit", F.expr("kept IS NOT NULL AND NOT page_id <=> kept")).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("kept"))
    )


def write_archives(
    pages: DataFrame,
    work: Workspace,
    *,
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = 3,
) -> DataFrame:
    """Archive ``pages`` (page_id, url, html); returns the written archives: path, records, bytes.

    A null html is an empty payload, a null url leaves its header out. Without pages there are no
    archives. Other columns are not archived. Of rows that repeat the kept id and payload each is a
    response; a page of any length is one record and is held in memory whole. ``bytes`` is the length
    of the file, of which the dictionary's frame is the first part.
    """
    chosen = choose_responses(pages, work, min_bytes)
    folder = f"{work.folder}/warc-{uuid4().hex}"
    file_system(folder)  # fails here, not in tasks, where files cannot be written
    records = pages.select("page_id", F.encode("html", "UTF-8").alias("payload"))
    records = records.where(F.octet_length("payload") > 0)
    records = records.withColumn("order", F.xxhash64("page_id", "payload"))
    records = records.withColumn("payload", F.substring("payload", 1, SAMPLE_RECORD_BYTES))
    # Only hashes are ranked; the records themselves are fetched afterwards, few from each task.
    last = records.select("order").orderBy("order").limit(SAMPLE_RECORDS).agg(F.max("order")).first()[0]
    sample = records.where(F.col("order") <= last).limit(SAMPLE_RECORDS).collect() if last is not None else []
    records = [record_bytes(r[0], None, bytes(r[1]), payload_digest(bytes(r[1])), None, False, "") for r in sample]
    dictionary = train_dictionary(records)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        task = TaskContext.get()
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=level)
        squeeze = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True).compress
        out, path, count, size, archives = None, "", 0, 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]})

        for batch in batches:
            names = ("page_id", "url", "payload", "digest", "refers_to", "revisit")
            for k, (page, url, payload, digest, refers, revisit) in enumerate(
                zip(*(batch.column(n).to_pylist() for n in names), strict=True)
            ):
                if out is None:
                    if not archives:
                        system.create_dir(root, recursive=True)
                    name = f"{task.partitionId():06d}-{archives:04d}-{task.taskAttemptId()}.warc.zst"
                    path, count, archives = f"{folder}/{name}", 0, archives + 1
                    # The name's ending must not make the stream compress once more.
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    size = out.write(dictionary_frame(dictionary))
                frame = squeeze(record_bytes(page, url, payload, digest, refers, revisit, f"{path}#{count}#{k}"))
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= archive_bytes:
                    out.close()
                    yield listed()
                    out = None
        if out is not None:
            out.close()
            yield listed()

    return work.keep(chosen.mapInArrow(write, "path STRING, records BIGINT, bytes BIGINT"))


def read_archives(archives: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """The records of ``archives`` (path), one task per archive.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, [payload]. The
    payload of each response is digested again; a record that differs from its header is an error.
    """
    kinds = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if with_payload else {})
    schema = pa.schema(list(kinds.items()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            folder, name = path.rsplit("/", 1)
            system, root = file_system(folder)
            rows, held = [], 0
            with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for headers, block in read_records(stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"the payload differs from its digest in {path}")
                    row = {
                        "page_id": int(headers["X-Page-Id"]) if "X-Page-Id" in headers else None,
                        "url": headers.get("WARC-Target-URI"),
                        "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]),
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": int(r) if (r := headers.get("X-Refers-To-Page-Id")) else None,
                    }
                    if with_payload:
                        row["payload"] = payload if kind == "response" else None
                    rows.append(row)
                    held += len(payload) if with_payload else 0
                    if len(rows) >= 5000 or held >= 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    from pyspark.sql.pandas.types import from_arrow_schema

    count = archives.count()
    spread = archives.select("path").repartition(max(count, 1))
    return spread.mapInArrow(read, from_arrow_schema(schema))
