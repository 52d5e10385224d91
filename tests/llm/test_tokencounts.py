import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from velograph.llm import tokencounts
from velograph.llm.tokencounts import PieceCounter, count_tokens, read_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello world, it's 2024!", " lead", "  a  b ", "▁▁x", "\n\t日本 x😀😀y", "", None, "<s> <0x41> <unk>", "a b",
    "word " * 3000, "Donaudampfschifffahrt", "ééé",
]


def reference(vocabulary, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_those_of_the_tokenizer(spark, monkeypatch):
    expected = reference(read_vocabulary(PATH), True)
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(TEXTS)], "doc_id INT, text STRING, n_tokens STRING")
    found = count_tokens(docs, PATH).collect()
    assert [r["n_tokens"] for r in found] == [expected(TEXTS[r["doc_id"]]) for r in found]
    assert count_tokens(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("scores", [(-1.0, -1.0, -1.0, -2.0, -2.0), (-3.0, -1.0, -1.0, -2.0, -4.0)])
def test_ties_and_unknown_characters(scores):
    pieces = ["▁", "a", "aa", "aaa", "b"]
    vocabulary = [("<unk>", 0.0), *zip(pieces, scores, strict=True)]
    expected, counter = reference(vocabulary, False), PieceCounter(vocabulary)
    for text in ("a", "aa", "aaa", "aaaa", "aaaaaaa", "ab", "xab", "xyab", "axxa", "axbyyx", "x"):
        assert counter.count("▁" + text) == expected(text), text


def test_forgotten_words_are_counted_anew(monkeypatch):
    monkeypatch.setattr(tokencounts, "_MEMORY_WORDS", 2)
    memory = tokencounts._Memory(PieceCounter(read_vocabulary(PATH)))
    text = "one two three one four five one"
    assert tokencounts.tokens_in(text, memory) == reference(read_vocabulary(PATH), True)(text)
