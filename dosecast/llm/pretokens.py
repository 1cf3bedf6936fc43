"""Pre-tokens of a word BPE tokenizer with a Split pattern, as its library makes them.

The pattern has no look-around and no alternative that takes white space, so the pieces of a text are
those of its white-space runs one after the other. Most runs repeat, so their pieces are kept.
"""

from __future__ import annotations

import json
import unicodedata

import regex
from tokenizers import Tokenizer

# fixed values: Unicode White_Space characters, and those at which only str.split() splits
_ONLY_PYTHON_SPLITS = regex.compile("[\x1c-\x1f]")
_WHITE_SPACE = regex.compile(r"\p{White_Space}+")


class WordBpe:
    """The parts of a tokenizer file: normalisation, pre-tokens, byte symbols, vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self._specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        self.byte_symbols = byte_symbols()

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """The text cut at special tokens: (is special, part). They are found before normalisation."""
        if not any(s in text for s in self.special):
            return [(False, text)]
        return [(i % 2 == 1, part) for i, part in enumerate(self._specials.split(text))]

    def words(self, part: str) -> list[str]:
        """Normalised white-space runs of a part without special tokens."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final form in the library
        part = part.lower()
        if _ONLY_PYTHON_SPLITS.search(part):
            return [w for w in _WHITE_SPACE.split(part) if w]
        return part.split()

    def pieces(self, word: str) -> list[str]:
        return self._pieces(word)

    def symbols(self, piece: str) -> str:
        """The piece as one character for each UTF-8 byte."""
        if piece.isascii() and piece.isprintable() and " " not in piece:
            return piece
        return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.byte_symbols)


def byte_symbols() -> dict[int, str]:
    """Byte to printable character: printable Latin-1 stays, the rest counts up from 256."""
    stays = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in stays}
    moved = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(moved)}
