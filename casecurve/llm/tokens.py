"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import pack

# No token crosses into white space that follows something else: texts are cut there.
_SPACE = r" \t\n\r\f\v"
_CUTS = re.compile(rf"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
# What the quick cut is not for: runs of white space (two characters of these), and other kinds of it.
_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\f", "\v", "\0")
_FOREIGN = tuple(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
# Words that are one unit of the tokenizer's own splitting after a cut into letters and signs; an
# apostrophe may join the letters after it, so words with one are left to the tokenizer.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+|[.,;:!?*$&%#|()\[\]<>=+/\"\-]+")
_REMEMBERED = 3 << 18


def _byte_letters() -> dict[int, str]:
    """Byte to the letter that stands for it in byte-level vocabularies: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


_LETTER = _byte_letters()


def _lettered(unit: str) -> str:
    if unit.isascii():
        return unit.replace(" ", _LETTER[32])
    return unit.encode().decode("latin-1").translate(_LETTER)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def words_of(text: str) -> list[str]:
    """``text`` cut where no token crosses; the whole of it if it holds white space of other kinds."""
    if any(c in text for c in (_FOREIGN[:4] if text.isascii() else _FOREIGN)):
        return [text]
    if any(c in text for c in _RUNS):
        return _CUTS.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


class Encoder:
    """Encodes ordinary text with the tokenizers library, each different word once while it is remembered.

    Added tokens of the file are not looked for: ``TextEncoder`` cuts texts at them first. For byte-level BPE files whose pattern splits letters, signs and white space. A fixed number of words
    is remembered and then forgotten, so memory is bounded; what is forgotten costs only time.
    """

    def __init__(self, path: str, remembered: int = _REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's name in a text is ordinary text
        self.model = self.tokenizer.model
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def _ids(self, word: str) -> bytes:
        units = _PLAIN.findall(word)
        if len(word) > 200 or "".join(units) != word:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        else:
            # The units are known, so the model itself is asked.
            tokenize = self.model.tokenize
            ids = [t.id for u in units for t in tokenize(_lettered(u))]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        known = self.known
        words = words_of(text)
        found = list(map(known.get, words))
        if None in found:
            if len(known) > self.remembered:
                known.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    if (ids := known.get(word)) is None:
                        ids = known[word] = self._ids(word)
                    found[i] = ids
        return b"".join(found)


class TextEncoder:
    """The ids that the library gives for a whole text with ``add_special_tokens=False``.

    As there, the contents of the file's added tokens are found first and are one id each; what lies between
    two of them is encoded by itself.
    """

    def __init__(self, path: str, remembered: int = _REMEMBERED) -> None:
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens of this file are not found by their contents alone")
        self.ordinary = Encoder(path, remembered)
        self.added = {t["content"]: pack("<I", t["id"]) for t in added}
        # Of several at one place the longest is meant.
        names = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        encode = self.ordinary.encode
        if self.cuts is None or not any(name in text for name in self.added):
            return encode(text)
        # Every second part is an added token.
        parts = self.cuts.split(text)
        return b"".join(self.added[part] if i % 2 else encode(part) for i, part in enumerate(parts) if part)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and file."""
    return TextEncoder(path)
