"""Cut long texts for jobs that count words: nothing longer than a piece is ever split into a word list."""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE = 1 << 20
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Parts of UTF-8 bytes that end at an ASCII character other than a letter, so no word is cut."""
    at = 0
    while len(raw) - at > size:
        found = _BREAK.search(raw, at + size)
        end = found.end() if found else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw
