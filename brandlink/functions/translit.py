"""Latin-to-ASCII transliteration table for the slug expression.

The table is built by rule: every code point from U+00A0 to U+024F is
compatibility-decomposed (NFKD) and its combining marks are dropped; when
what remains is ASCII it becomes the mapping.  Letters that have no
decomposition take their spelling from ``NO_DECOMPOSITION`` below.

Single-character results feed one ``translate`` call; multi-character and
deleting results become ``replace`` calls.  Everything stays a native column
expression (no Python worker).
"""

from __future__ import annotations

import unicodedata

# ASCII spellings of letters (and two signs) that Unicode does not
# decompose, as a transliterating slug function writes them.
NO_DECOMPOSITION = {
    "ß": "ss", "ẞ": "SS",
    "Æ": "AE", "æ": "ae",
    "Œ": "OE", "œ": "oe",
    "Ø": "O", "ø": "o",
    "Đ": "D", "đ": "d",
    "Ð": "D", "ð": "d",
    "Þ": "Th", "þ": "th",
    "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h",
    "Ŧ": "T", "ŧ": "t",
    "Ŋ": "Ng", "ŋ": "ng",
    "ı": "i", "ĸ": "q", "ƒ": "f",
    "×": "x", "÷": "/",
    "‘": "", "’": "", "‚": "", "′": "",
}

_FIRST, _LAST = 0x00A0, 0x024F


def _by_rule(ch: str) -> str | None:
    decomposed = unicodedata.normalize("NFKD", ch)
    stripped = "".join(c for c in decomposed if not unicodedata.combining(c))
    if stripped != ch and stripped.isascii():
        return stripped
    return None


def build_table() -> tuple[dict[str, str], dict[str, str]]:
    """Return (single-char map, multi-char or deleting map)."""
    single: dict[str, str] = {}
    multi: dict[str, str] = {}
    chars = [chr(cp) for cp in range(_FIRST, _LAST + 1)] + [
        c for c in NO_DECOMPOSITION if not _FIRST <= ord(c) <= _LAST]
    for ch in chars:
        out = NO_DECOMPOSITION.get(ch)
        if out is None:
            out = _by_rule(ch)
        if out is None:
            continue
        if len(out) == 1:
            single[ch] = out
        else:
            multi[ch] = out
    return single, multi


SINGLE, MULTI = build_table()
