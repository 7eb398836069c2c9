"""What the two tokenizer files do to a text before byte-pair merging: special strings, normalising, words, byte symbols.

A text is first cut at special strings (they stand for their own ids), then normalised, then cut into words by the
file's pattern; the UTF-8 bytes of a word, as printable symbols, are what the merge list works on.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import regex

#: The usual pattern of byte-level BPE (fixed value; the file names it only by ``use_regex``).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for themselves, the others follow at 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


SYMBOLS = byte_symbols()
BYTES = {symbol: byte for byte, symbol in SYMBOLS.items()}
TABLE = {byte: symbol for byte, symbol in SYMBOLS.items()}


def to_symbols(word: str) -> str:
    """The bytes of ``word`` as symbols."""
    if word.isascii() and word.replace(" ", "").isprintable():
        return word.replace(" ", TABLE[32])
    return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(TABLE)


class Pretokens:
    """The steps before merging, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges: list[tuple[str, str]] = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"{path}: a normaliser that is not known here: {kinds}")
        self.lower = bool(kinds)
        before = spec["pre_tokenizer"]
        self.keeps_space = before["type"] == "ByteLevel"
        pattern = BYTE_LEVEL if self.keeps_space else before["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer

    def normalise(self, text: str) -> str:
        """Latin text, composed and lower-cased where the file asks for it."""
        if not self.lower:
            return text
        return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()

    def cut(self, text: str) -> list[str]:
        """Words of a text without special strings. Beyond the Latin blocks the classes of characters differ between
        versions of Unicode; there the library's own normaliser and pattern decide. ASCII letters, with or without a space
        in front, are one byte-level word."""
        if text.isascii() or max(text) <= "\u024f":
            if self.keeps_space and text.isascii() and text.removeprefix(" ").isalpha():
                return [text]
            return self.find(self.normalise(text))
        if self.lower:
            text = self.normalizer.normalize_str(text)
        return [bytes([BYTES[c] for c in word]).decode() for word, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str | int]:
        """Words in order; a special string is its id."""
        if self.cut_special is None or "<" not in text:
            return self.cut(text)
        out: list[str | int] = []
        for n, part in enumerate(self.cut_special.split(text)):
            if n % 2:
                out.append(self.special[part])
            elif part:
                out += self.cut(part)
        return out


@lru_cache(maxsize=4)
def pretokens(path: str) -> Pretokens:
    return Pretokens(path)
