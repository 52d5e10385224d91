"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton over the vocabulary lists all pieces within a word, by their ends. Dynamic
programming over these carries the best score and its number of pieces to each end. Ties fall as in
unigram tokenizers: at equal scores the piece that starts first stays, and a character that no piece
covers alone counts as unknown, at the lowest score less ten. Each distinct word is counted once per
worker process as long as it keeps coming up.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The mark of a word's start, and the penalty of an unknown character.
WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0

# Distinct words that each of the two generations of the memory holds.
_MEMORY_WORDS = 300_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class PieceCounter:
    """Counts pieces; unknown characters count as their bytes where the vocabulary has byte pieces."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int | None = 0) -> None:
        self.scores = [score for _, score in vocabulary]
        self.unknown_score = min(self.scores) - UNKNOWN_PENALTY
        pieces = {piece for piece, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def count(self, word: str) -> int:
        """Number of pieces of one word."""
        size = len(word)
        best: list[float | None] = [0.0] + [None] * size
        pieces = [0] * (size + 1)
        # Whether the path to an end closes with unknown characters, which count as one where fused.
        unknown = [False] * (size + 1)
        found = self.automaton.iter(word)
        ahead = next(found, None)
        for end in range(1, size + 1):
            single = False
            while ahead is not None and ahead[0] == end - 1:
                length, score = ahead[1]
                start = end - length
                single = single or length == 1
                total = score + best[start]
                if best[end] is None or total > best[end]:
                    best[end], pieces[end], unknown[end] = total, pieces[start] + 1, False
                ahead = next(found, None)
            if not single:
                total = self.unknown_score + best[end - 1]
                if best[end] is None or total > best[end]:
                    best[end], unknown[end] = total, True
                    if self.bytes:
                        pieces[end] = pieces[end - 1] + len(word[end - 1].encode())
                    else:
                        pieces[end] = pieces[end - 1] + (not unknown[end - 1])
        return pieces[size]


class _Memory(dict):
    def __init__(self, counter: PieceCounter) -> None:
        super().__init__()
        self._count, self._older = counter.count, {}

    def __missing__(self, word: str) -> int:
        count = self._older.get(word)
        if count is None:
            count = self._count(WORD_MARK + word)
        if len(self) >= _MEMORY_WORDS:
            self._older = dict(self)
            self.clear()
        self[word] = count
        return count


_memories: dict[str, _Memory] = {}


def _memory(path: str) -> _Memory:
    if path not in _memories:
        _memories[path] = _Memory(PieceCounter(read_vocabulary(path)))
    return _memories[path]


def tokens_in(text: str, memory: _Memory) -> int:
    """Tokens of a whole text: each space opens a word, and so does the text itself."""
    if not text:
        return 0
    words = text.replace(WORD_MARK, " ")
    words = words[1:] if words[0] == " " else words
    return sum(map(memory.__getitem__, words.split(" ")))


def count_tokens(documents: DataFrame, model_path: str, *, text: str = "text", result: str = "n_tokens") -> DataFrame:
    """``documents`` with a column ``result``, the number of tokens of the whole text.

    A null or empty text has none. An input column called ``result`` is replaced; all others pass
    through, equal rows each get the same count.
    """
    source = documents.drop(result)
    names = source.columns
    schema = T.StructType([*source.schema.fields, T.StructField(result, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model_path)
        for batch in batches:
            counts = [tokens_in(t.as_py() or "", memory) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, type=pa.int64())], names=[*names, result])

    return source.mapInArrow(work, schema)
