"""Token ids of whole texts, as a `tokenizers` file gives them, by way of its words.

Both kinds of vocabulary used here cut a text into pieces by a pattern before any
merge, and the ids of a piece depend on nothing else. Texts of ordinary characters
are cut here and each different piece is encoded once by the library; all other
texts go to the library whole. Ids are the same either way.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import regex

from marlstone.llm.common import environment_for_workers

CACHED_PIECES = 400_000
"""Pieces remembered in each of two generations, of MAX_PIECE characters at most."""

MAX_PIECE = 64

#: Characters on which this cutting and the library's normalizers agree.
ORDINARY = re.compile(r"[\t\n\r\x20-\x7e¡-ÿ]*")

#: Letters and numbers among the ordinary characters.
_LETTERS, _NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"

#: The patterns of the two vocabulary files. The first is written out for
#: ordinary characters, on which it finds the same pieces at half the time.
WORD_END_PATTERN = re.compile(
    rf"[{_LETTERS}]+|[{_NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^\s{_LETTERS}{_NUMBERS}]+"
)
BYTE_LEVEL_PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, the
    others as the characters from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {b: 256 + n for n, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def _packed(ids) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """Encodes texts as the file does, without special tokens added.

    `pattern` cuts texts into the file's pieces and `lowers` says whether it
    lower-cases them; without a pattern all texts go to the library whole.
    """

    def __init__(self, path: str, pattern=None, *, lowers: bool = False):
        environment_for_workers()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = self.library.model
        self.pattern, self.lowers = pattern, lowers
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not young; most become young."""
        long_ones = {}
        for p in pieces:
            ids = self.old.get(p)
            if ids is None:
                # Plain letters are written as they are.
                letters = p
                if not (p.isascii() and p.isalnum()):
                    letters = p.encode().decode("latin-1").translate(BYTE_LETTERS)
                ids = _packed([t.id for t in self.merges.tokenize(letters)])
            (self.young if len(p) <= MAX_PIECE else long_ones)[p] = ids
        return long_ones

    def _ids(self, text: str) -> bytes:
        plain = self.pattern is not None and "<|" not in text
        if not plain or not ORDINARY.fullmatch(text):
            encoded = self.library.encode_batch_fast([text], add_special_tokens=False)
            return _packed(encoded[0].ids)
        pieces = self.pattern.findall(text.lower() if self.lowers else text)
        unknown = set(pieces).difference(self.young)
        long_ones = self._learn(unknown) if unknown else {}
        if long_ones:
            found = b"".join(
                [long_ones.get(p) or self.young.get(p, b"") for p in pieces]
            )
        else:
            found = b"".join(map(self.young.__getitem__, pieces))
        if len(self.young) >= CACHED_PIECES:
            self.old, self.young = self.young, {}
        return found

    def ids(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; none for NULL."""
        for text in texts:
            yield self._ids(text) if text else b""
