"""Token ids of whole texts with a public tokenizer, fast enough for large tables.

Both kinds of tokenizer file used here split a text into words before they merge bytes, and
no word reaches over a cut between a character that isn't white space and a following space
or line feed.  A text is therefore encoded piece by piece, and each distinct piece only once
per worker: the ids are those of the whole text.  New pieces of plain Latin characters go
straight to the library's BPE model, word by word; all others through its whole encoder.  A
text that has no other characters is cut into its words at once.  A text that holds the string
of one of the file's special tokens, in upper or lower case, is encoded whole: the library
gives such a string the id of its token.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

CACHE = 1_000_000          # distinct pieces and words that a worker remembers, half of each (about 200 MB)
PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")
# printable ASCII and precomposed Latin letters whose lower case is one character
PLAIN = re.compile("[ \n!-~¡-¬®-įĲ-ɏ]*")
# word patterns of the two files: fixed values
SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACELESS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same for plain characters, letters first: no other word begins with one
LETTERS, NUMERALS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
PLAIN_SPACED = re.compile(rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMERALS}]+| ?[^ \n{LETTERS}{NUMERALS}]+"
                          r"|[ \n]+(?![^ \n])|[ \n]+")
PLAIN_SPACELESS = re.compile(rf"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMERALS}]|[^ \n{LETTERS}{NUMERALS}]+")
MARKS = re.compile("[!-/:-@[-`{-~]+")

_encoders: dict[str, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: bytes that print stand for themselves, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of the keys that were asked for, at most ``most`` of them."""

    def __init__(self, ids, most: int):
        super().__init__()
        self.ids, self.most = ids, most

    def __missing__(self, key: str) -> bytes:
        found = self.ids(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = found
        return found


class Encoder:
    """``ids(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs one task per core
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        # no letter's lower case is a punctuation mark, so a text without a special string's marks has no such string
        self.marks = sorted({max(MARKS.findall(s), key=len, default="") for s in self.special})
        self.model = self.tokenizer.model
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16       # ids fit 16 bits
        with open(path, encoding="utf-8") as f:
            self.spaced = json.load(f)["pre_tokenizer"]["type"] == "ByteLevel"
        self.words = regex.compile(SPACED if self.spaced else SPACELESS).findall
        self.plain_words = (PLAIN_SPACED if self.spaced else PLAIN_SPACELESS).findall
        self.letters = _byte_letters()
        self.known = _Known(self._piece, CACHE // 2)
        self.known_words = _Known(self._word, CACHE // 2)

    def _word(self, word: str) -> bytes:
        spelled = word.encode("utf-8").decode("latin-1").translate(self.letters)
        found = self.model.tokenize(spelled)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _piece(self, piece: str) -> bytes:
        if PLAIN.fullmatch(piece):
            return b"".join(map(self.known_words.__getitem__, self.words(piece if self.spaced else piece.lower())))
        return self._whole(piece)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if any(m in text for m in self.marks):
            low = text.lower()
            if any(s in low for s in self.special):
                return self._whole(text)
        if PLAIN.fullmatch(text):
            return b"".join(map(self.known_words.__getitem__, self.plain_words(text if self.spaced else text.lower())))
        if self.spaced:
            if OTHER_SPACE.search(text):        # tabs and the like: cuts aren't safe
                return self._whole(text)
            pieces = PIECE.findall(text)
        else:
            pieces = text.replace("\n", " ").split(" ")
        return b"".join(map(self.known.__getitem__, pieces))


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
