"""Scalar column helpers: trims, substring tests, parsing, dates, formatting.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """``String.trim()``: strip every char <= U+0020 at both ends.

    Spark's ``trim`` strips only the space character.
    """
    return F.regexp_replace(as_col(c), "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def contains(c, needle: str) -> Column:
    """plain substring test."""
    return as_col(c).contains(F.lit(needle))


def parse_number(c, to: str = "double", permissive: bool = False) -> Column:
    """parse text to a number; fails the query on bad input unless permissive."""
    c = java_trim(c)
    return c.try_cast(to) if permissive else c.cast(to)


def coerce_double(c) -> Column:
    """Coerce to double, null becoming 0.0 (primitive coercion)."""
    return F.coalesce(as_col(c).cast("double"), F.lit(0.0))


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """text to DATE (null when it does not parse)."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("date")


def reformat_date(c, in_fmt: str | None = "yyyy-MM-dd", out_fmt: str = "yyyy",
                  invalid: str = "Invalid Date") -> Column:
    """P5: replace a date by its reformatted text, ``invalid`` when unparsable.
    ``in_fmt=None`` means the column already holds dates or timestamps."""
    col = as_col(c)
    parsed = col if in_fmt is None else F.try_to_timestamp(col.cast("string"), F.lit(in_fmt))
    return F.coalesce(F.date_format(parsed, out_fmt), F.lit(invalid))


def format_decimals(c, places: int = 8) -> Column:
    """F16: ``DecimalFormat("###.########")`` text: at most 8 decimals, no
    trailing zeros, no trailing point."""
    txt = F.bround(as_col(c), places).cast("decimal(38,18)").cast("string")
    txt = F.regexp_replace(txt, "(\\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(txt, "\\.$", "")


def fixed_width(name, count, width: int = 35) -> Column:
    """``"%-35s%d"`` report line."""
    return F.format_string(f"%-{width}s%d", as_col(name), as_col(count))


def composite_key(*cols, sep: str = ", ") -> Column:
    """``a + sep + b`` string key."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def bytes_to_string(c, charset: str = "UTF-8") -> Column:
    """decode bytes."""
    return F.decode(as_col(c), charset)


def string_to_bytes(c, charset: str = "UTF-8") -> Column:
    """encode text."""
    return F.encode(as_col(c), charset)


def first_char_partition(c, n: int, base: str | None = None) -> Column:
    """Partition index from the first character: ``code(c0) mod n`` or
    ``(code(c0) - code(base)) mod n``; always in ``[0, n)`` (pmod)."""
    code = F.ascii(java_trim(c))
    if base is not None:
        code = code - F.lit(ord(base))
    return F.pmod(code, F.lit(n))
