"""Expressions over SQL text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Comments, or the shortest runs that cannot start one. Literals are not special.
_PIECES = r"(--[^\n]*|/\*[\s\S]*?(?:\*/|\z)|[^-/]++|[-/])"
#: Every character that ends a line.
_LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
_BLANK = r"[\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
BLANKS_AT_END = rf"{_BLANK}+\z"
_NOQA = r"(?iU)--\s*noqa\b(?::\s*([\w\s,]+))?"
_ASTRAL_WORD = r"[\x{10000}-\x{10FFFF}&&[\p{L}\p{N}]]"
_ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def pieces(text: Column) -> Column:
    """The text as an array of comments and of runs without one."""
    return F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1))


def ends_in_comment(text: Column) -> Column:
    """Whether a block comment is open at the end of a text that begins outside of one."""
    last = F.element_at(pieces(text), -1)
    closed = (F.length(last) >= 4) & last.endswith("*/")
    return F.when(text.contains("/*"), last.startswith("/*") & ~closed).otherwise(F.lit(False))


def blank_comments(text: Column) -> Column:
    """The text with comments overwritten by spaces; offsets and newlines stay."""
    blanked = F.array_join(
        F.transform(
            pieces(text),
            lambda p: F.when(
                p.startswith("--") | p.startswith("/*"), F.regexp_replace(p, r"[^\n]", " ")
            ).otherwise(p),
        ),
        "",
    )
    return F.when(text.contains("--") | text.contains("/*"), blanked).otherwise(text)


def one_unit(text: Column) -> Column:
    """The text with characters outside the basic plane replaced by one inside.

    Regex positions count UTF-16 units; after this they count characters.
    """
    return F.when(
        ~is_ascii(text) & text.rlike(_ASTRAL), F.regexp_replace(F.regexp_replace(text, _ASTRAL_WORD, "\u00e6"), _ASTRAL, "\u3013")
    ).otherwise(text)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def lines(text: Column) -> Column:
    return F.split(text, _LINE_ENDS)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def has_text(line: Column) -> Column:
    # Most lines begin, after spaces, with a visible ASCII character.
    return F.left(F.ltrim(line), F.lit(1)).between("!", "~") | line.rlike(f"[^{_BLANK[1:]}")


def has_noqa(line: Column) -> Column:
    return line.contains("--") & line.rlike(_NOQA)


def noqa_codes(line: Column) -> Column:
    """Upper-case codes of the line's first noqa mark; empty for a bare mark."""
    listed = F.split(F.regexp_extract(line, _NOQA, 1), ",")
    return F.filter(F.transform(listed, lambda c: F.upper(stripped(c))), lambda c: c != "")
