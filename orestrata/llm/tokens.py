"""Encode texts with a public tokenizer of the tokenizers library, each distinct word once.

Both vocabularies split a text into words by a fixed pattern before they merge, so a text's ids are its words'
ids one after the other. The split is done here with the same pattern; the library encodes the words that are not
in the cache yet, many in one call. The split is only used for texts of common Latin characters, for which Python's
character classes and the library's agree; any other text goes to the library as a whole.
"""
from __future__ import annotations

import json
import re
import struct
import unicodedata
from pathlib import Path

import numpy as np

from orestrata.llm.common import keeps_cache, own_caches

#: The contractions of both public split patterns.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Words and pieces kept per Python worker; the cache starts anew beyond it (about 200 bytes each).
CACHED_WORDS = 900_000
LAST_COMMON = 0x24F


def _group(first: str) -> str:
    """Common characters whose Unicode category starts with ``first``, as the inside of a character class."""
    codes = [c for c in range(LAST_COMMON + 1) if unicodedata.category(chr(c))[0] == first]
    runs: list[list[int]] = []
    for c in codes:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


L, N = _group("L"), _group("N")
UNCOMMON = re.compile(f"[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ac\\u00ae-\\u{LAST_COMMON:04x}]|<\\|")
#: By the kind of pre-tokenizer in the file.
BYTE_LEVEL = re.compile(f"{CONTRACTIONS}| ?[{L}]+| ?[{N}]+| ?[^\\s{L}{N}]+|\\s+(?!\\S)|\\s+")
LOWER_WORDS = re.compile(f"{CONTRACTIONS}|[{L}]+|[{N}]|[^\\s{L}{N}]+")


#: Spacing after which words and pieces between blanks do not coincide.
IRREGULAR = ("\t", "\r", "  ", " \n", "\n ", "\n\n")
BLANKS = (" ", "\n")
ENDS = (",", ".")
#: A blank and a line break in the public byte-level alphabet.
BLANK, BREAK = "\u0120", "\u010a"


def _visible_bytes() -> dict[int, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """``encode(texts)`` gives an array of uint32 ids for each text, as the library does. ``plain`` says that strings of special
    tokens are ordinary text; without it, which is the library's default, they become the special ids."""

    def __init__(self, path: str, plain: bool = False, cached: int | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.cached = cached
        self.lower = json.loads(Path(path).read_text())["normalizer"] is not None
        self.split = (LOWER_WORDS if self.lower else BYTE_LEVEL).findall
        self.visible = _visible_bytes()
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = self.words[word] = self._merged(word)
        return got

    def _merged(self, word: str) -> bytes:
        if word.isascii():
            shown = word.replace(" ", BLANK).replace("\n", BREAK)
        else:
            shown = word.encode().decode("latin-1").translate(self.visible)
        ids = [t.id for t in self.library.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            # a piece stands behind one blank, but for those that begin with a line break
            lead = "" if self.lower or piece[:1] == "\n" else " "
            if piece.isalpha():
                got = self._merged(lead + piece)
            elif piece[-1:] in ENDS and piece[:-1].isalpha():
                got = self._piece(piece[:-1]) + self._word(piece[-1])
            else:
                got = b"".join(map(self._word, self.split(lead + piece)))
            self.pieces[piece] = got
        return got

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        odd = "<|" in text or not text.replace("\n", "").isprintable() if text.isascii() else UNCOMMON.search(text)
        if odd or self.lower and not unicodedata.is_normalized("NFC", text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.pieces) + len(self.words) > (self.cached or CACHED_WORDS):
            self.words.clear()
            self.pieces.clear()
        if self.lower:
            first, pieces = b"", text.lower().split()
        elif any(map(text.__contains__, IRREGULAR)) or text[:1] in BLANKS or text[-1:] in BLANKS:
            return b"".join(map(self._word, self.split(text)))
        else:
            head, *pieces = text.replace("\n", " \n").split(" ")
            first = b"".join(map(self._word, self.split(head)))
        try:
            return first + b"".join(map(self.pieces.__getitem__, pieces))
        except KeyError:
            return first + b"".join(map(self._piece, pieces))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.encode_bytes(t), dtype="<u4") for t in texts]


_ENCODERS: dict[tuple, Encoder] = {}
keeps_cache("tokens", _ENCODERS)


def encoder(path: str, plain: bool = False, cached: int | None = None) -> Encoder:
    """One per Python worker, file and kind, kept between tasks until another operator's run here."""
    own_caches("tokens")
    key = (path, plain, cached)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
