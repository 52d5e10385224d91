"""Token ids in files: ranked by frequency, byte-aligned, with control bytes apart from the data bytes.

An id is stored as its rank among the corpus' ids, the most frequent first, in as few whole bytes as that
takes, one to four. The lengths are kept apart: a control byte holds those of four ranks, two bits each,
so that a reader finds all places by looking control bytes up in a table and summing, without a loop
over ids.

Format, little-endian throughout. ``ranks.bin``: the mark, then one unsigned 32-bit id per rank. An id
file: the mark, then blocks. A block: numbers of pieces, ids and data bytes (unsigned 64-bit); of its pieces
the document ids (signed 64-bit), the numbers of ids (unsigned 64-bit) and the flags (one byte: 1 no
document id, 2 goes on in the next block); control bytes; data bytes. Documents follow in ascending order of
their ids, over all files; a long one is cut over blocks, so a reader holds one block at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velograph.llm import bytepairs
from velograph.llm.common import Workspace, file_system, slices

# Fixed values of the file format.
RANKS_MARK = b"VGRANKS1"
IDS_MARK = b"VGCODES1"
_NO_ID, _GOES_ON = 1, 2

END_ID = 0
# Ids after which a block is closed, and ids that are worth a file.
BLOCK_IDS = 1 << 20
IDS_PER_FILE = 1 << 26

_ROW_BITS = 33

# By control byte: the bytes of each of its four ranks. By number of bytes: the bits that belong to a rank.
_LENGTHS = 1 + ((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    fours = np.concatenate([codes, np.zeros(-len(codes) % 4, dtype=np.uint8)]).reshape(-1, 4)
    control = (fours << (2 * np.arange(4, dtype=np.uint8))).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks again, by table lookup."""
    lengths = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:count]
    ends = np.cumsum(lengths)
    if len(data) != (ends[-1] if count else 0):
        raise ValueError("control bytes and data bytes do not belong together")
    padded = data + bytes(3)
    # The four bytes from each place on; the mask leaves those of the rank.
    words = np.ndarray(shape=(len(data),), dtype="<u4", buffer=padded, strides=(1,))
    return words[ends - lengths] & _MASKS[lengths]


def block_bytes(pieces: list[tuple[int | None, np.ndarray, bool]]) -> bytes:
    """A block of pieces: document id, ranks, whether the document goes on in the next block."""
    sizes = np.array([len(r) for _, r, _ in pieces], dtype="<u8")
    keys = np.array([k or 0 for k, _, _ in pieces], dtype="<i8")
    flags = np.array([_NO_ID * (k is None) + _GOES_ON * more for k, _, more in pieces], dtype=np.uint8)
    control, data = encode_ranks(np.concatenate([r for _, r, _ in pieces]))
    head = np.array([len(pieces), sizes.sum(), len(data)], dtype="<u8")
    return b"".join(x.tobytes() for x in (head, keys, sizes, flags)) + control + data


def read_blocks(stream) -> Iterator[list[tuple[int | None, np.ndarray, bool]]]:
    """The pieces of each block of an id file."""

    def exactly(size: int) -> bytes:
        found = stream.read(size)
        if len(found) < size:
            raise ValueError("an id file is cut short")
        return found

    if exactly(len(IDS_MARK)) != IDS_MARK:
        raise ValueError("not an id file")
    while head := stream.read(24):
        if len(head) < 24:
            raise ValueError("an id file is cut short")
        pieces, count, size = np.frombuffer(head, dtype="<u8").astype(np.int64).tolist()
        keys = np.frombuffer(exactly(8 * pieces), dtype="<i8").tolist()
        sizes = np.frombuffer(exactly(8 * pieces), dtype="<u8").astype(np.int64)
        flags = np.frombuffer(exactly(pieces), dtype=np.uint8).tolist()
        control = exactly(-(-count // 4))
        ranks = decode_ranks(control, exactly(size), count)
        parts = np.split(ranks, np.cumsum(sizes)[:-1])
        yield [
            (None if f & _NO_ID else k, part, bool(f & _GOES_ON))
            for k, part, f in zip(keys, parts, flags, strict=True)
        ]


def read_ranks(system, root: str) -> np.ndarray:
    """The id of each rank."""
    with system.open_input_stream(f"{root}/ranks.bin", compression=None) as stream:
        stored = stream.read()
    if stored[: len(RANKS_MARK)] != RANKS_MARK:
        raise ValueError("not a table of ranks")
    return np.frombuffer(stored[len(RANKS_MARK) :], dtype="<u4")


def _narrow(ids: np.ndarray) -> np.ndarray:
    """In two bytes each where all of a document's ids have room in them."""
    return ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids


def _tokenized(source: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, row, n, ids of every document; a task's last row has how often it met each id instead.

    Ids are of two bytes or of four, all of a document alike.
    """
    schema = "doc_id BIGINT, row BIGINT, n BIGINT, ids BINARY, counts ARRAY<STRUCT<id: BIGINT, n: BIGINT>>"
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("row", pa.int64()),
            ("n", pa.int64()),
            ("ids", pa.binary()),
            ("counts", pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))),
        ]
    )
    ending = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bytepairs.load(tokenizer_path).ids
        row = TaskContext.get().partitionId() << _ROW_BITS
        seen = np.zeros(0, dtype=np.int64)
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            ids = [np.frombuffer(encode(t.as_py() or "") + ending, dtype="<u4") for t in batch.column("text")]
            here = np.bincount(np.concatenate(ids), minlength=len(seen))
            here[: len(seen)] += seen
            seen = here
            rows = pa.array(range(row, row + batch.num_rows), type=pa.int64())
            row += batch.num_rows
            sizes = pa.array([len(i) for i in ids], type=pa.int64())
            packed = [_narrow(i).tobytes() for i in ids]
            none = pa.nulls(batch.num_rows, kinds.field("counts").type)
            columns = [batch.column("doc_id"), rows, sizes, pa.array(packed, type=pa.binary()), none]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)
        if len(seen):
            met = np.flatnonzero(seen)
            counts = [{"id": i, "n": n} for i, n in zip(met.tolist(), seen[met].tolist(), strict=True)]
            yield pa.RecordBatch.from_pylist([{"counts": counts}], schema=kinds)

    return source.mapInArrow(work, schema)


def write_token_files(
    documents: DataFrame,
    tokenizer_path: str,
    work: Workspace,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    ids_per_file: int = IDS_PER_FILE,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write the ids of all documents; returns the files: path, number, first_id, documents, ids, bytes.

    Each document's ids are those of the whole text and ``end_id``; a null or empty text is the end id
    alone. Documents are in ascending order of their ids, a null id first; rows that share an id are
    ordered by their number of ids, then by the ids; equal rows are all written. ``first_id`` is the
    number of ids in the files before. Other columns are not read. Without rows there are no files.

    Texts are tokenized once and kept as ids. The table of ranks is the only thing that the driver
    holds and sends out; it has one entry per id of the vocabulary, whatever the corpus. Files are
    written by tasks under names of their own and count only once Spark has committed their list.
    """
    source = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    tokenized = work.keep(_tokenized(source, tokenizer_path, end_id))
    counts = (
        tokenized.where("counts IS NOT NULL")
        .select(F.inline("counts"))
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "id")
        .collect()
    )
    total = sum(r["n"] for r in counts)
    ids = np.array([r["id"] for r in counts], dtype="<u4")
    ranks = np.zeros(int(ids.max(initial=0)) + 1, dtype="<u4")
    ranks[ids] = np.arange(len(ids))
    folder = f"{work.folder}/ids-{uuid4().hex}"
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/ranks.bin", compression=None) as out:
        out.write(RANKS_MARK + ids.tobytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = file_system(folder)
        task = TaskContext.get()
        number = task.partitionId()
        name = f"{number:06d}-{task.taskAttemptId()}.ids"
        out, pieces, held, n_documents, n_ids, n_bytes = None, [], 0, 0, 0, 0
        for batch in batches:
            names = ("doc_id", "n")
            for key, n, stored in zip(*(batch.column(c).to_pylist() for c in names), batch.column("ids"), strict=True):
                if out is None:
                    out = files.open_output_stream(f"{at}/{name}", compression=None)
                    n_bytes = out.write(IDS_MARK)
                stored = stored.as_buffer()
                found = ranks[np.frombuffer(stored, dtype=f"<u{stored.size // n}")]
                n_documents, n_ids = n_documents + 1, n_ids + len(found)
                while len(found):
                    part, found = found[: block_ids - held], found[block_ids - held :]
                    pieces.append((key, part, len(found) > 0))
                    held += len(part)
                    if held == block_ids:
                        n_bytes += out.write(block_bytes(pieces))
                        pieces, held = [], 0
        if out is not None:
            if pieces:
                n_bytes += out.write(block_bytes(pieces))
            out.close()
            found = {"path": f"{folder}/{name}", "number": number, "documents": n_documents, "ids": n_ids, "bytes": n_bytes}
            yield pa.RecordBatch.from_pylist([found])

    # Small data is spread over the cores that there are, large data over files of the size asked for.
    parallel = documents.sparkSession.sparkContext.defaultParallelism
    files = max(1, -(-total // ids_per_file), min(parallel, total // BLOCK_IDS))
    order = ["doc_id", "n", F.xxhash64("ids"), "row"]
    placed = tokenized.where("ids IS NOT NULL").repartitionByRange(files, *order).sortWithinPartitions(*order)
    written = work.keep(
        placed.select("doc_id", "n", "ids").mapInArrow(
            write, "path STRING, number BIGINT, documents BIGINT, ids BIGINT, bytes BIGINT"
        )
    )
    work.drop(tokenized)
    # One row per file: few, whatever the data.
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """The documents of ``files`` (path, first_id): doc_id, start, n_tokens, ids_crc32, [ids].

    ``start`` counts the ids of all documents before. One task reads a file, block by block.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int64()))] if with_ids else []
    schema = pa.schema(fields)
    types = [T.StructField(n, T.ArrayType(T.LongType()) if n == "ids" else T.LongType()) for n, _ in fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
                folder, name = path.rsplit("/", 1)
                system, root = file_system(folder)
                ids_of = read_ranks(system, root)
                tokens, digest, parts = 0, 0, []
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for pieces in read_blocks(stream):
                        rows = []
                        for key, ranks, more in pieces:
                            ids = ids_of[ranks]
                            digest = zlib.crc32(ids, digest)
                            tokens += len(ids)
                            if with_ids:
                                parts.append(ids)
                            if not more:
                                rows.append((key, start, tokens, digest, *([np.concatenate(parts)] if with_ids else [])))
                                start, tokens, digest, parts = start + tokens, 0, 0, []
                        columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                        )

    spread = files.select("path", "first_id").repartition(max(files.count(), 1))
    return spread.mapInArrow(read, T.StructType(types))
