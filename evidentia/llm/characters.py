"""Character tables: what cannot be seen, the kinds of blank, and letters that look alike."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

# Characters without a visible form (joiners, marks of direction, soft hyphen, fillers).
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x202A, 0x202B, 0x202C, 0x202D, 0x202E, 0x2060, 0x2061, 0x2062, 0x2063, 0x2064, 0x2066, 0x2067, 0x2068, 0x2069, 0x206A, 0x206B, 0x206C, 0x206D, 0x206E, 0x206F, 0x3164, 0xFE00, 0xFE01, 0xFE02, 0xFE03, 0xFE04, 0xFE05, 0xFE06, 0xFE07, 0xFE08, 0xFE09, 0xFE0A, 0xFE0B, 0xFE0C, 0xFE0D, 0xFE0E, 0xFE0F, 0xFEFF, 0xFFA0]

# Kinds of blank.
BLANK = [0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0085, 0x00A0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Cyrillic, Greek and other letters drawn like a Latin letter, and that letter; hyphens drawn like hyphen-minus.
ALIKE = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ԍ": "G", "Ӏ": "I",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ү": "y", "х": "x", "ԝ": "w", "ѵ": "v",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "ο": "o", "ν": "v", "α": "a", "ι": "i", "ρ": "p", "ϲ": "c", "ϳ": "j", "υ": "u", "κ": "k", "χ": "x",
    "\u2010": "-", "\u2011": "-",
    "ɑ": "a", "ɡ": "g", "ı": "i", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "Տ": "S", "Լ": "L", "Օ": "O", "Ս": "U",
}


@lru_cache(1)
def single() -> dict[int, str]:
    """Code point -> what it becomes on its own ('' if invisible); only those that change. Composed accents and syllables stay composed."""
    out: dict[int, str] = {}
    changing = []
    for lo in range(0x80, 0xF0000, 0x80):
        if not 0xD800 <= lo <= 0xF8FF:
            block = "".join(map(chr, range(lo, lo + 0x80)))
            if unicodedata.normalize("NFKC", block) != block:  # of a text in one form every part is
                changing.append(range(lo, lo + 0x80))
    for c in chain(*changing):
        if 0xAC00 <= c <= 0xD7A3 or 0xD800 <= c <= 0xDFFF or 0xE000 <= c <= 0xF8FF or c >= 0xF0000:
            continue
        ch = chr(c)
        n = unicodedata.normalize("NFKC", ch)
        if n != ch:
            out[c] = n
    for c in BLANK:
        out[c] = " "
    for c in INVISIBLE:
        out[c] = ""
    for a, b in ALIKE.items():
        out[ord(a)] = b
    for c, n in list(out.items()):  # what a mapping gives is mapped as well, to the end
        m = "".join(out.get(ord(x), x) for x in n)
        out[c] = unicodedata.normalize("NFKC", m)
    return out


@lru_cache(1)
def folding() -> dict[int, str]:
    """single() and, beyond it, accents taken off; for matching of wordings only."""
    out = dict(single())
    for c in range(0xC0, 0x250):
        d = unicodedata.normalize("NFD", chr(c))
        if len(d) > 1:
            out[c] = d[0]
    for c in range(0x300, 0x370):
        out[c] = ""
    return out


def pairs_1to1(table: dict[int, str], upto: int = 0x10000) -> tuple[str, str]:
    """The part of a table that maps one character to one or none, as the two strings that translate() takes."""
    ones = [(chr(c), n) for c, n in table.items() if len(n) == 1 and c < upto]
    none = [chr(c) for c, n in table.items() if not n and c < upto]
    return "".join(a for a, _ in ones) + "".join(none), "".join(b for _, b in ones)
