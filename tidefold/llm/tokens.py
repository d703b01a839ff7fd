"""Token ids of whole texts, word by word, with a bounded cache.

Both byte-pair tokenizers in use part a text before every run of white space at the latest, so
a text's ids are the ids of its blank-separated pieces in order. Pieces recur, and the
tokenizers library takes microseconds for each; a piece is encoded once and then looked up.
A cut is made only at a blank that follows a visible character, which is always a border. Where a
vocabulary parts a single line feed from both its neighbours, texts without runs of white space are cut
before their line feeds, too, so the end of a line and the start of the next are not a piece together.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

from tokenizers import Tokenizer

from tidefold.llm.common import sole_cache, worker_cache

CACHE_PIECES = 700_000
_CUT = re.compile(r"(?<=\S) ")
_ODD_BLANK = re.compile(r"\s ")
_RUN = re.compile(r"\s\s")
_TAIL = ".,;:!?"
# Lower case that depends on the neighbours or adds a mark; what Python alone takes for white space.
_ODD_LOWER = "Σİ\x1c\x1d\x1e\x1f"


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 and on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 0x100 + n for n, b in enumerate(others)}


class _Pieces(dict):
    """piece -> ids (little-endian unsigned 32-bit) of a blank and the piece; of a piece that starts a line, of itself."""

    def __init__(self, owner: "PieceEncoder"):
        super().__init__()
        self.owner = owner

    def __missing__(self, piece: str) -> bytes:
        core = piece if piece.isalpha() else piece.rstrip(_TAIL)
        if len(core) < len(piece) and core[-1:].lower().isalnum():
            ids = self[core] + self.owner.tail(piece[len(core):])
        elif self.owner.lines and piece[:1] == "\n":
            ids = self.owner.line(piece)
        else:
            ids = self.owner.word(piece)
        if len(self) >= CACHE_PIECES:
            self.clear()
        self[piece] = ids
        return ids


class PieceEncoder:
    """Encodes whole texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        normalizers = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cutter = spec["pre_tokenizer"]
        byte_level = (cutter.get("type") == "ByteLevel" and not spec.get("normalizer"))
        self.lowers = normalizers == ["NFC", "Replace", "Lowercase"]
        self.direct = byte_level or self.lowers
        self.lines = byte_level and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
        self.letters = _byte_letters()
        self.blank = "" if self.lowers else chr(self.letters[0x20])
        self.tails: dict[str, bytes] = {}
        self.pieces = _Pieces(self)

    def plain(self, text: str) -> bytes:
        """Ids as the library gives them."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def tail(self, text: str) -> bytes:
        if text not in self.tails:
            if len(self.tails) >= CACHE_PIECES:
                self.tails.clear()
            self.tails[text] = self.plain(text)
        return self.tails[text]

    def unit(self, mapped: str) -> bytes:
        """Ids of one unit of the model, written in its own alphabet."""
        return array("I", [token.id for token in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def line(self, piece: str) -> bytes:
        """A line feed and what follows it."""
        if piece.isascii() and piece[1:].isalpha():
            return self.tail("\n") + self.unit(piece[1:])
        return self.plain(piece)

    def word(self, piece: str) -> bytes:
        """A word of letters is one unit for the model; anything else takes the full way."""
        if self.direct and piece.isalpha():
            word = piece
            if piece.isascii():
                return self.unit(self.blank + (piece.lower() if self.lowers else piece))
            if self.lowers:
                word = piece.lower()
                if "Σ" in piece or not word.isalpha() or not unicodedata.is_normalized("NFC", piece):
                    return self.plain(" " + piece)
            return self.unit(self.blank + word.encode("utf-8").decode("latin-1").translate(self.letters))
        return self.plain(" " + piece)

    def encode(self, text: str) -> bytes:
        if self.lowers and not any(odd in text for odd in _ODD_LOWER) and unicodedata.is_normalized("NFC", text):
            # White space and case make no difference here, so they need no pieces of their own.
            return b"".join(map(self.pieces.__getitem__, text.lower().split()))
        if _RUN.search(text) or text[:1] == " ":
            pieces = _CUT.split(text) if _ODD_BLANK.search(text) or text[:1] == " " else text.split(" ")
            if self.lines and " \n" in text:
                # Here a piece that starts with a line feed has its blank before it.
                rest = [self.plain(" " + piece) if piece[:1] == "\n" else self.pieces[piece] for piece in pieces[1:]]
                return (self.plain(pieces[0]) if pieces[0] else b"") + b"".join(rest)
        else:
            pieces = (text.replace("\n", " \n") if self.lines else text).split(" ")
        first = self.plain(pieces[0]) if pieces[0] else b""
        return first + b"".join(map(self.pieces.__getitem__, pieces[1:]))


_encoders: dict[str, PieceEncoder] = worker_cache({})


def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process and tokenizer file."""
    sole_cache(_encoders)
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
