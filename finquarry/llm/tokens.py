"""Token ids of public vocabularies, remembered by chunk.

Both BPE vocabularies tokenise the stretches between single spaces independently: the
word vocabulary drops white space, the byte vocabulary joins one space to what follows.
So a text is cut at its spaces, ids of each chunk are looked up, and only new chunks go
through the tokenizers library. Plain chunks (ASCII and Latin-1 letters) are cut into
words here and only the words go to the library's BPE model; all others are encoded whole
by the library. Runs of white space that a cut could change are not cut.
"""

from __future__ import annotations

import os
import re
import struct
import weakref

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[\n!-;=-~{LETTER}]*")  # without "<", which begins special tokens
HELD_BYTES = 160 << 20  # about the bytes a worker holds before it starts anew
ENTRY = 190  # bytes of a place in a dict with its two objects, without their content

#: How the two vocabularies split text, for plain chunks.
WORD_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")
BYTE_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+")
RAGGED = re.compile(r"\s |[ ]\s")


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


_held: list[weakref.ref] = []
_worker = {"stage": ""}


def working_for(stage: str) -> None:
    """Workers live on from stage to stage: what an earlier one remembered is dropped when another begins."""
    if _worker["stage"] != stage:
        _worker["stage"] = stage
        for ref in _held:
            if (held := ref()) is not None:
                held.forget()
        _held[:] = [ref for ref in _held if ref() is not None]


class Held(dict):
    """A dict from text to bytes that computes what is missing and starts anew when it is full."""

    def __init__(self, make, most_bytes: int = HELD_BYTES):
        super().__init__()
        _held.append(weakref.ref(self))
        self.make, self.most, self.bytes = make, most_bytes, 0

    def forget(self) -> None:
        self.clear()
        self.bytes = 0

    def __missing__(self, key):
        value = self.make(key)
        self.bytes += ENTRY + len(key) + len(value)
        if self.bytes > self.most:
            self.clear()
            self.bytes = ENTRY + len(key) + len(value)
            if self.bytes > self.most:  # too long to be kept at all
                self.bytes = 0
                return value
        self[key] = value
        return value


PACKED = [struct.Struct(f"<{n}I") for n in range(64)]


def packed(ids: list[int]) -> bytes:
    return PACKED[len(ids)].pack(*ids) if len(ids) < len(PACKED) else struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = byte_letters()
        self.tokenize = self.library.model.tokenize
        self.by_words = getattr(self.library.model, "end_of_word_suffix", None) is not None
        self.words = Held(self._word)
        self.chunks = Held(self._chunk)

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        # the letters of ASCII bytes stand at their code points; others are mapped byte by byte
        mapped = word.translate(self.letters) if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return packed([t.id for t in self.tokenize(mapped)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():  # one word
            return self.words[chunk.lower() if self.by_words else " " + chunk]
        if not PLAIN.fullmatch(chunk):
            return self.whole(chunk if self.by_words else " " + chunk)
        pieces = WORD_SPLIT.findall(chunk.lower()) if self.by_words else BYTE_SPLIT.findall(" " + chunk)
        return b"".join(map(self.words.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if self.by_words:
            return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))
        if RAGGED.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.chunks.__getitem__, rest)) if text else b""


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    working_for(f"tokens of {path}")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
