"""Token ids of texts by the tokenizers library, with whole-word results kept in each worker.

A byte-level BPE splits a text by a fixed pattern and merges inside each part on its own. Parts
repeat, so each distinct one is handed to the library once per worker. That holds for texts of
characters whose class every Unicode version agrees on; any other text goes to the library whole.
"""

from __future__ import annotations

import ctypes
import gc
import re
from array import array

import public_tokenizers

# Texts of these characters only are cut here.
_OTHER = re.compile("[^\t\n\r\x20-\x7e¡-ɏ‐-‧€]")

# The split pattern of the vocabulary, letters and digits spelt out up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_PART = re.compile(
    f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\\s{_LETTER}{_DIGIT}]+|\\s+(?!\\S)|\\s+"
)

# Distinct parts in each of the two halves of what a worker keeps (some 20 MB a half), and the
# longest that is kept.
KEPT_PARTS = 150_000
KEPT_CHARS = 48


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte: printable bytes themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(rest)}


class _Parts(dict):
    """Ids of a part as little-endian unsigned 32-bit bytes, found on first use.

    When this half is full it becomes the older one, from which parts still in use come back.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.cut = tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            spelt = part.encode().decode("latin-1").translate(self.letters)
            ids = _bytes([t.id for t in self.cut(spelt)])
        if len(part) <= KEPT_CHARS:
            if len(self) >= KEPT_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    assert out.itemsize == 4
    return out.tobytes()


class Encoder:
    """``encode(text)`` gives the ids as bytes; strings of special tokens are ordinary text."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        self.whole.encode_special_tokens = True
        self.size = self.whole.get_vocab_size()
        split = self.whole.pre_tokenizer
        state = split.__getstate__() if split is not None else b""
        plain = self.whole.normalizer is None and b'"ByteLevel"' in state and b'"add_prefix_space":false' in state
        self.parts = _Parts(self.whole) if plain and b'"use_regex":true' in state else None

    def encode(self, text: str) -> bytes:
        if self.parts is None or _OTHER.search(text):
            return _bytes(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.parts.__getitem__, _PART.findall(text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One per worker process and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def forget() -> None:
    """Give the memory of encoders back. A worker serves one operator after the other, and what the
    last one kept counts against the next."""
    if not _ENCODERS:
        return
    _ENCODERS.clear()
    gc.collect()
    # Where the C library has it, hand freed pages back to the system.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
