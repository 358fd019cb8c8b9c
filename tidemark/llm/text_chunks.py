"""Cutting texts at single spaces, and a bounded memory of what each chunk gave.

For tokenizers whose pieces hold white space only in front, a single space between two other
characters starts a new piece whatever surrounds it. So a text is the concatenation of its
first chunk and of the later ones with their space, and each distinct chunk needs the costly
work once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_DOUBLE = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: Latin letters whose class, composed form and lower case no Unicode version or rule changes.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: ASCII punctuation but the apostrophe, which may start a contraction.
PUNCTUATION = r"!-&(-/:-@\[-`{-~"


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: its own where that
    is a visible Latin-1 character, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


_BYTES = _byte_characters()
#: For ``str.translate``: letters of ``LATIN`` beyond ASCII as the characters of their bytes.
BYTE_LEVEL = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
SPACE, LINE_BREAK = _BYTES[0x20], _BYTES[0x0A]

#: Chunks remembered before the memory starts anew.
CACHE_ENTRIES = 600_000
#: Longer chunks are worked out each time, so that entries stay small.
CACHE_KEY_CHARS = 64


def single_spaced(text: str) -> bool:
    """Whether no two white-space characters are neighbours."""
    return _DOUBLE.search(text) is None


def chunks(text: str) -> list[str]:
    """The text cut before every single space; the spaces themselves are left out."""
    if not single_spaced(text):
        return _CUT.split(text)
    return text.split(" ")


class RecentCache(dict):
    """``cache[key]`` is ``compute(key)``; it holds ``entries`` keys at most and then starts anew,
    which costs each of the frequent keys one computation."""

    def __init__(self, compute: Callable, entries: int = CACHE_ENTRIES,
                 key_chars: int = CACHE_KEY_CHARS):
        super().__init__()
        self.compute, self.entries, self.key_chars = compute, entries, key_chars

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.key_chars:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value
