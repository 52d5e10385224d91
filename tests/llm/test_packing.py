import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from velograph.llm import bytepairs
from velograph.llm.packing import cut_points, differencing, pack, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Hello world, it's 2024!",
    "",
    None,
    "  two  spaces \n\n and\tlines \n x",
    "a <|endoftext|> b  <|endoftext|>",
    "word " * 5000,
    "ünïcödé 日本語 😀 " * 30,
    " lead",
    "trail ",
    " nbsp  x",
    "word",
    "word",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_ids_are_those_of_the_tokenizer(tokenizer):
    encoder = bytepairs.BytePairs(PATH)
    for text in TEXTS:
        assert encoder.ids(text or "") == ids_of(tokenizer, text)[:-1].tobytes(), text


def test_ids_after_the_memory_is_full(tokenizer, monkeypatch):
    monkeypatch.setattr(bytepairs, "_MEMORY_PIECES", 3)
    encoder = bytepairs.BytePairs(PATH)
    text = "one two three one four five one six two seven"
    assert encoder.ids(text) == ids_of(tokenizer, text)[:-1].tobytes()


def test_each_id_lies_in_one_piece_and_windows_have_no_gaps(spark, tokenizer):
    rows = [(k, t, k) for k, t in enumerate(TEXTS * 30)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING, start INT").repartition(3)
    pieces = pack_documents(docs, PATH, windows_per_group=4, with_ids=True).toPandas()
    for key, own in pieces.groupby("doc_id"):
        ids, own = ids_of(tokenizer, rows[key][1]), own.sort_values("start")
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert (own["doc_tokens"] == len(ids)).all() and own["length"].sum() == len(ids)
        for row in own.itertuples():
            part = ids[row.start : row.start + row.length]
            assert zlib.crc32(part.tobytes()) == row.ids_crc32 and list(row.ids) == part.tolist()
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() <= 2048
    assert len(set(pieces["doc_id"])) == len(rows)
    assert pieces["length"].sum() / (2048 * pieces["sequence_id"].nunique()) > 0.95


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "a"), (1, "a")], "doc_id BIGINT, text STRING")
    pieces = pack_documents(docs, PATH)
    assert sorted(r["length"] for r in pieces.collect()) == [1, 2, 2, 2]
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_differencing_gives_near_equal_windows():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 513, 800)
    window = differencing(lengths, 90)
    sums = np.bincount(window, weights=lengths, minlength=90)
    assert sums.sum() == lengths.sum() and sums.max() - sums.min() < 0.03 * sums.mean()
    assert sorted(np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]


def test_windows_are_added_while_one_is_too_full():
    window, offset = pack(np.array([1500, 1500, 1500]), 2048)
    assert sorted(window.tolist()) == [0, 1, 2] and offset.tolist() == [0, 0, 0]


def test_cut_points():
    assert cut_points(1, 8, 4) == [(0, 1)]
    assert cut_points(8, 8, 4) == [(0, 8)]
    assert cut_points(21, 8, 4) == [(0, 8), (8, 8), (16, 4), (20, 1)]
