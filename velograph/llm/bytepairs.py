"""Token ids of a byte-level BPE vocabulary file, fast enough for whole corpora.

The ids are those of ``tokenizers`` with ``add_special_tokens=False``. Where the file's ids follow
its merge order, the text is cut before each single space that opens a word, which no token spans,
and each distinct piece is encoded once and looked up afterwards. Texts in which a cut could change
the ids (white space beside white space, strings of special tokens) are encoded whole, and any other
file is left to ``tokenizers``.
"""

from __future__ import annotations

import json
from array import array

# Distinct pieces that each of the two generations of the memory holds.
_MEMORY_PIECES = 300_000


class _Irregular(Exception):
    pass


class _Memory(dict):
    """Piece to the bytes of its ids. Pieces not asked for during a whole generation are forgotten."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace():
            raise _Irregular
        ids = self._older.get(piece)
        if ids is None:
            ids = array("I", self._encode(" " + piece)).tobytes()
        if len(self) >= _MEMORY_PIECES:
            self._older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairs:
    """Encoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        self._fast = self._ranked(path)
        if self._fast:
            self._memory = _Memory(self._fast.encode_ordinary)
            self._special = sorted(self._fast.special_tokens_set)

    @staticmethod
    def _ranked(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type", "BPE") == "BPE" and splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space")
        if not plain or spec.get("normalizer") or any(model.get(k) for k in ("byte_fallback", "ignore_merges")):
            return None
        known = _byte_characters()
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        in_order = [model["vocab"].get(m.replace(" ", "")) for m in merges]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if in_order != list(range(256, 256 + len(in_order))):
            return None
        ranks = {bytes(known[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._fast is None or any(s in text for s in self._special):
            return array("I", self._slow.encode(text, add_special_tokens=False).ids).tobytes()
        head, space, rest = text.partition(" ")
        try:
            first = array("I", self._fast.encode_ordinary(head)).tobytes()
            return first + b"".join(map(self._memory.__getitem__, rest.split(" "))) if space else first
        except _Irregular:
            return array("I", self._slow.encode(text, add_special_tokens=False).ids).tobytes()


_loaded: dict[str, BytePairs] = {}


def load(path: str) -> BytePairs:
    """The encoder for ``path``, made once per process."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]
