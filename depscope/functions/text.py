"""Text helpers. ``""`` and null both mean "missing" in the text-based tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything the sources treat as blank around a value, not just the space character.
WHITESPACE = "".join(
    chr(c) for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ])


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove all kinds of white space at both ends."""
    return F.trim(col(c), F.lit(WHITESPACE))


def strip_line(c: Column | str) -> Column:
    """``strip`` for JSON lines: trimming walks over the whole text, and few need it."""
    c = col(c)
    return F.when(c.startswith("{") & c.endswith("}"), c).otherwise(strip(c))


def is_braced(c: Column | str) -> Column:
    """True for a text that opens and closes with a brace, white space aside."""
    text = strip_line(c)
    return text.startswith("{") & text.endswith("}")


def present(c: Column | str) -> Column:
    """The value, or null where it is an empty text."""
    return F.nullif(col(c), F.lit(""))


def or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def first_present(*cols: Column | str) -> Column:
    """First value that is neither null nor empty; ``0`` and ``false`` do count."""
    return F.coalesce(*[present(c) for c in cols])


def safe_str(c: Column | str, n: int = 4000) -> Column:
    return F.substring(or_empty(c), 1, n)


def sha1_or_empty(c: Column | str) -> Column:
    """SHA-1 hex of the UTF-8 bytes; nothing to hash gives nothing."""
    c = or_empty(c)
    return F.when(c != "", F.sha1(c)).otherwise("")


def comma_to_semicolon(c: Column | str) -> Column:
    return F.translate(col(c), ",", ";")


def joined_parts(**parts: Column) -> Column:
    """``name=value|name=value`` of the parts that hold something."""
    return F.concat_ws(
        "|", *[F.concat(F.lit(f"{name}="), present(value)) for name, value in parts.items()])
