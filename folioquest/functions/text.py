"""Column functions with the string semantics of the document model: lengths in code points, Unicode white space and case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that Unicode calls white space, and the separators 1C to 1F; as characters, and for a pattern's class.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACE = "".join(f"\\x{{{ord(c):x}}}" for c in SPACES)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(as_column(c), F.lit(SPACES))


def words(c: Column | str) -> Column:
    """The words between white space; none for an empty text."""
    return F.filter(F.split(as_column(c), f"[{SPACE}]+"), lambda w: w != "")


def word_set(c: Column | str) -> Column:
    return F.array_distinct(words(F.lower(as_column(c))))


def hits(c: Column, terms: tuple[str, ...]) -> Column:
    """How many of the terms the text contains. A loop over an array: the terms' list stays out of the generated code."""
    if not terms:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(c, t)))


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def count_of(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def overlap(candidate: Column, kept: Column, by: str) -> Column:
    """Shared words over those of the candidate, or over the larger set; 0 where that has none."""
    shared = F.size(F.array_intersect(candidate, kept))
    size = F.size(candidate) if by == "candidate" else F.greatest(F.size(candidate), F.size(kept))
    return F.when(size > 0, shared / size).otherwise(F.lit(0.0))


def escape_html(c: Column | str) -> Column:
    out = as_column(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def stem(c: Column | str) -> Column:
    """A file name without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(as_column(c), r"(?<=.)\.[^.]+$", "")
