"""Cleaning, matching and tokenizing of strings."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Every blank that Unicode has (White_Space).
BLANKS = "".join(map(chr, (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def line_trim(line: Column) -> Column:
    """Trims space, tab, CR and LF, and no other blank; a pattern would be tried at every character of a long line."""
    return F.btrim(line, F.lit(" \n\r\t"))


def unicode_trim(x: Column) -> Column:
    """Trims every blank that Unicode has, such as U+00A0."""
    return F.btrim(x, F.lit(BLANKS))


def text(x: Column) -> Column:
    """Trimmed; null is empty."""
    return F.coalesce(unicode_trim(x), F.lit(""))


def null_if_empty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def filled(x: Column, other: Column) -> Column:
    """``x``, or ``other`` where it is empty."""
    return F.coalesce(null_if_empty(x), other)


def ascii_lower(x: Column) -> Column:
    return F.translate(x, _UPPER, _LOWER)


def like_ascii_ci(x: Column, pattern: str) -> Column:
    """LIKE that folds the case of ASCII letters alone. ``%`` and ``_`` are wildcards; there is no escape character."""
    low = pattern.translate(str.maketrans(_UPPER, _LOWER)).replace("\\", "\\\\")
    return ascii_lower(x).like(low)


def spaced(a: Column, b: Column) -> Column:
    """Both with a space between, or what is not empty of them."""
    return F.trim(F.concat_ws(" ", null_if_empty(a), null_if_empty(b)))


# -- tokens ---------------------------------------------------------------------------------------------------------

#: Combining marks that are removed; every other mark separates.
MARKS = "".join(map(chr, (0x300, 0x301, 0x302, 0x303, 0x304, 0x306, 0x307, 0x308, 0x309, 0x30A, 0x30B, 0x30C, 0x30F, 0x311, 0x31B, 0x323, 0x324, 0x325, 0x326, 0x327, 0x328, 0x32D, 0x32E, 0x330, 0x331)))
#: Lower-case letters that fold to others.
FOLDS = {"ς": "σ", "ſ": "s", "µ": "μ", "ϐ": "β", "ϑ": "θ", "ϕ": "φ", "ϖ": "π", "ϰ": "κ", "ϱ": "ρ", "ϵ": "ε"}
#: The Latin blocks in which precomposed letters lose their marks.
LATIN = ((0xC0, 0x24F), (0x1E00, 0x1EFF))


@functools.cache
def _bases() -> tuple[str, str]:
    """Precomposed Latin letters whose marks are all among MARKS, and their base letters, both in lower case."""
    source, target = [], []
    for lo, hi in LATIN:
        for c in map(chr, range(lo, hi + 1)):
            base, *marks = unicodedata.normalize("NFD", c)
            # letters with a base that is not ASCII (such as Ǣ) stay
            if marks and base.isascii() and all(m in MARKS for m in marks) and not (0x1E0 <= ord(c) <= 0x1E1 or 0x1E2 <= ord(c) <= 0x1E3):
                source.append(c)
                target.append(base.lower())
    return "".join(source), "".join(target)


def fold(x: Column) -> Column:
    """Lower case, folded letters, Latin letters without marks; marks removed. ASCII has none of the latter."""
    source, target = _bases()
    plain = F.translate(F.lower(x), "".join(FOLDS), "".join(FOLDS.values()))
    return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(F.translate(plain, source, target), MARKS, ""))


def tokens(x: Column) -> Column:
    """Runs of letters, numbers and private-use characters, folded; in ASCII by a class that is matched some times faster."""
    runs = F.regexp_extract_all(fold(x), F.lit(r"([\p{L}\p{N}\p{Co}]+)"), 1)
    return F.when(F.octet_length(x) == F.char_length(x), F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), 0)).otherwise(runs)


def query_tokens(query: Column) -> Column:
    """Runs of letters and numbers of the lower-cased query, each folded like a document's."""
    return F.transform(F.regexp_extract_all(F.lower(query), F.lit(r"([\p{L}\p{N}]+)"), 1), fold)
