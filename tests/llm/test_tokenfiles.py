import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from velograph.llm import QUERIES
from velograph.llm.common import Workspace, file_system
from velograph.llm.queries import tokenizer_path
from velograph.llm.tokenfiles import (
    IDS_MARK,
    block_bytes,
    decode_ranks,
    encode_ranks,
    read_blocks,
    read_ranks,
    read_token_files,
    write_token_files,
)

SCHEMA = "doc_id BIGINT, text STRING, ids STRING, n INT, row STRING, counts INT"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_ranks_come_back(ranks):
    control, data = encode_ranks(np.array(ranks, dtype=np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
    assert decode_ranks(control, data, len(ranks)).tolist() == ranks


def test_block_layout():
    pieces = [(7, np.array([0, 1, 256], dtype=np.uint32), False), (None, np.array([70_000], dtype=np.uint32), True)]
    stored = IDS_MARK + block_bytes(pieces)
    # Bytes of each rank, less one, two bits each: 1, 1, 2 and 3 bytes.
    assert stored[8 + 24 + 16 + 16 + 2] == 0b10_01_00_00
    assert stored[-7:] == bytes([0, 1, 0, 1, 0x70, 0x11, 0x01])
    back = [(k, r.tolist(), m) for block in read_blocks(io.BytesIO(stored)) for k, r, m in block]
    assert back == [(7, [0, 1, 256], False), (None, [70_000], True)]
    with pytest.raises(ValueError, match="cut short"):
        list(read_blocks(io.BytesIO(stored[:-1])))


def expected_rows(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    encoded = [(k, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for k, t in rows]
    encoded.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    found, start = [], 0
    for key, ids in encoded:
        found.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


ROWS = [
    (5, "Some words, twice. Some words, twice."),
    (5, "Some words, twice. Some words, twice."),
    (5, "short"),
    (3, None),
    (4, ""),
    (None, "no id"),
    (-2, "é 漢字 <|endoftext|>   spaces\n\n"),
    (9, "many more words " * 20_000),
    (10, "one"),
]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, "y", 2) for k, t in rows], SCHEMA)


@pytest.mark.parametrize("block", [1 << 20, 1000])
def test_files_hold_what_the_tokenizer_gives(spark, block):
    files = write_token_files(frame(spark, ROWS), tokenizer_path(), Workspace(spark), ids_per_file=20_000, block_ids=block)
    assert files.count() > 1
    found = read_token_files(files)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected_rows(ROWS)


def test_files_are_in_the_order_of_ids_and_ranks_in_the_order_of_counts(spark):
    files = write_token_files(frame(spark, ROWS), tokenizer_path(), Workspace(spark), ids_per_file=10_000)
    listed = files.orderBy("number").collect()
    order, seen = [], {}
    for row in listed:
        folder, name = row["path"].rsplit("/", 1)
        system, root = file_system(folder)
        ids_of = read_ranks(system, root)
        assert system.get_file_info(f"{root}/{name}").size == row["bytes"]
        with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
            for block in read_blocks(stream):
                for key, ranks, more in block:
                    order += [] if more else [key]
                    for i in ids_of[ranks].tolist():
                        seen[i] = seen.get(i, 0) + 1
    assert order == sorted((k for k, _ in ROWS), key=lambda k: (k is not None, k or 0))
    counts = [seen[i] for i in ids_of.tolist()]
    assert counts == sorted(counts, reverse=True)
    assert sum(counts) == sum(r["ids"] for r in listed)


def test_ids_themselves(spark):
    files = write_token_files(frame(spark, ROWS[:2]), tokenizer_path(), Workspace(spark))
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = [*tokenizer.encode(ROWS[0][1], add_special_tokens=False).ids, 0]
    assert [r["ids"] for r in read_token_files(files, with_ids=True).collect()] == [ids, ids]


def test_empty_table(spark):
    files = write_token_files(frame(spark, []), tokenizer_path(), Workspace(spark))
    assert files.count() == 0
    assert read_token_files(files).count() == 0


def test_a_folder_that_tasks_cannot_write_to_fails_at_once():
    with pytest.raises(ValueError, match="nosuch"):
        file_system("nosuch://host/folder")


def test_query_agrees_with_the_tokenizer(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_token_files"](spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected_rows(rows)
