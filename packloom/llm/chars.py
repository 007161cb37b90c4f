"""Characters that look alike: the tables behind the one consistent form of a text.

``canonical_table`` maps single code points to what a reader sees; ``EXPANSIONS`` maps the few code points that
stand for several letters. Everything that a rule can give is built from the Unicode database.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np

# Look-alike letters of the Cyrillic and Greek scripts and the Latin letters they are drawn like.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "Ѕ": "S", "І": "I", "Ј": "J", "Ѵ": "V", "Ү": "Y", "Һ": "H", "Ӏ": "I", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ѵ": "v", "ү": "y", "һ": "h",
    "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "Ϲ": "C", "Ϳ": "J", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "ι": "i", "ɡ": "g", "ɑ": "a", "ı": "i",
    "ヘ": "へ", "‐": "-", "‑": "-", "﹣": "-",
}
# Characters without a visible form (soft hyphen, joiners, direction marks, variation selectors).
INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xE0100, 0xE01EF)]
# Kinds of blank that read as one space.
BLANKS = [(0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
# Ranges whose compatibility forms are drawn like what they stand for.
COMPATIBLE = [(0xFF01, 0xFFEE), (0x2E80, 0x2FD5), (0x2160, 0x217F), (0xFB00, 0xFB06), (0xF900, 0xFAFF), (0xFE30, 0xFE6B), (0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2024, 0x2026), (0xB5, 0xB5), (0xE33, 0xE33), (0xEB3, 0xEB3)]


def _visible(ch: str) -> str:
    """What one code point of a compatible range is drawn like."""
    out = unicodedata.normalize("NFKC", ch)
    return ch if out.startswith(" ") else out


@functools.lru_cache(maxsize=1)
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """Single code points to single code points, and single ones to strings. Both are closed: no target is a source."""
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for a, b in COMPATIBLE:
        for ch in map(chr, range(a, b + 1)):
            if (to := _visible(ch)) != ch:
                (one if len(to) == 1 else many)[ch] = to
    for a, b in BLANKS:
        one.update((chr(o), " ") for o in range(a, b + 1))
    one.update(LOOKALIKES)
    # Accented letters of the look-alike scripts, by rule from their parts.
    for o in [*range(0x370, 0x530), *range(0x1F00, 0x2000), *range(0x30A0, 0x3100)]:
        parts = unicodedata.normalize("NFD", chr(o))
        if len(parts) > 1 and parts[0] in LOOKALIKES and chr(o) not in one:
            to = unicodedata.normalize("NFC", LOOKALIKES[parts[0]] + parts[1:])
            (one if len(to) == 1 else many)[chr(o)] = to
    seen = lambda s: "".join(one.get(c, c) for c in s)
    one = {k: seen(v) for k, v in one.items() if seen(v) != k}
    return one, {k: seen(v) for k, v in many.items()}


def char_class(ranges: list[tuple[int, int]], escape: str = "\\U{:08X}") -> str:
    """A regular-expression class of ``ranges``."""
    return "[" + "".join(escape.format(a) + (f"-{escape.format(b)}" if b > a else "") for a, b in ranges) + "]"


@functools.lru_cache(maxsize=1)
def _steps() -> tuple[re.Pattern, dict[int, str], dict[int, str]]:
    one, many = tables()
    return re.compile(char_class(INVISIBLE)), {ord(k): v for k, v in (one | many).items()}, {ord(k): v for k, v in many.items()}


THAI_TONE = re.compile("\u0e4d([\u0e48-\u0e4b])")


def canonical(text: str) -> str:
    """The consistent form of one text, as ``unify.canonical_sql`` computes it in DuckDB; for callers that need few texts."""
    if text.isascii():
        return text
    drop, table, _ = _steps()
    text = unicodedata.normalize("NFC", drop.sub("", text)).translate(table)
    return unicodedata.normalize("NFC", THAI_TONE.sub("\\1\u0e4d", text))


def pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` in one array, and the len(texts) + 1 offsets at which each begins."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], ends]).astype(np.int64)


@functools.lru_cache(maxsize=1)
def word_table() -> tuple[np.ndarray, frozenset[str]]:
    """For each code point its place in a word, compared without case and look-alikes: 0 separates, 1 is skipped.

    Also the characters that need ``canonical`` first, as they stand for several letters.
    """
    one, many = tables()
    points = np.zeros(0x110000, np.uint32)
    fold = {}
    for k, v in LOOKALIKES.items():  # a look-alike capital makes its small letter alike too
        if k.isalpha() and len(k.lower()) == 1:
            fold[k.lower()] = fold.get(k.lower(), v.lower())
    for o in range(0x110000):
        ch = chr(o)
        if ch.isalnum():
            ch = one.get(ch, ch)
            low = ch.lower()
            ch = low if len(low) == 1 else ch
            ch = fold.get(ch, ch)
            points[o] = ord(ch) + 2 if ch.isalnum() else 0
    for a, b in INVISIBLE:
        points[a : b + 1] = 1
    return points, frozenset(many)
