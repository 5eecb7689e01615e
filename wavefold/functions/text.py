"""Column expressions for fixed-width fields.

Every function returns a ``Column`` built from Spark SQL functions only, so a
whole layout becomes one generated projection that stays inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII characters Python's ``str.strip()`` treats as
# whitespace (tab, LF, VT, FF, CR, the four information separators U+001C to
# U+001F, and space).
ASCII_STRIP_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "

# Every character Python's ``str.strip()`` removes (the
# characters for which ``str.isspace()`` is true), in code point order.
UNICODE_STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Number grammars accepted by the typed parse (ASCII digits only).
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def is_ascii_line(value: Column) -> Column:
    """True when every character is one byte, so byte slicing equals char slicing."""
    return F.octet_length(value) == F.length(value)


def slice_ascii(value: Column, start: int, width: int, as_binary: Column | None = None) -> Column:
    """Byte-position slice (fast: no code-point walk), for ASCII-only lines.

    ``as_binary`` is the line already cast to binary, when the caller stages
    it once for all fields."""
    binary = as_binary if as_binary is not None else value.cast("binary")
    return F.substring(binary, start, width).cast("string")


def slice_chars(value: Column, start: int, width: int) -> Column:
    """Code-point slice, 1-based and inclusive of ``width`` characters."""
    return F.substring(value, start, width)


def strip_ascii(text: Column) -> Column:
    return F.trim(text, F.lit(ASCII_STRIP_CHARS))


def strip_unicode(text: Column) -> Column:
    """Strip exactly what ``str.strip()`` strips, without a regular expression."""
    return F.trim(text, F.lit(UNICODE_STRIP_CHARS))


def field_text(value: Column, start: int, width: int, ascii_flag: Column, as_binary: Column | None = None) -> Column:
    """Trimmed text of one field: byte path for ASCII lines, code points otherwise."""
    return F.when(ascii_flag, strip_ascii(slice_ascii(value, start, width, as_binary))).otherwise(
        strip_unicode(slice_chars(value, start, width))
    )


def missing_to_null(text: Column) -> Column:
    """Empty or dots-only text means missing; a value like ``.5`` is kept."""
    return F.when(F.trim(text, F.lit(".")) == "", F.lit(None).cast("string")).otherwise(text)


def parse_integer(text: Column, spark_type: str) -> Column:
    """Strict integer parse; anything outside the grammar or range is null."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(spark_type))


def parse_decimal(text: Column) -> Column:
    """Float parse with a decimal comma accepted, as the source files use it."""
    dotted = F.translate(text, ",", ".")
    return F.when(dotted.rlike(DECIMAL_PATTERN), dotted.try_cast("double"))


def typed_value(text: Column, storage_type: str) -> Column:
    if storage_type == "string":
        return text
    if storage_type == "float64":
        return parse_decimal(text)
    return parse_integer(text, {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}[storage_type])


def human_size(size: Column) -> Column:
    """``1.5 KiB`` style size; rounding is half-even on the exact value.

    ``size / 1024**k * 10`` is exact for realistic sizes, so ``bround`` on it
    gives the correctly rounded tenth that Python's ``format`` prints.
    """
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    value = size.cast("double")
    result = None
    for power, unit in enumerate(units):
        scaled = value / float(1024**power)
        tenths = F.bround(scaled * 10.0, 0).cast("long")
        text = F.concat(
            (tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(" " + unit)
        )
        condition = scaled < 1024 if unit != "TiB" else F.lit(True)
        result = F.when(condition, text) if result is None else result.when(condition, text)
    return F.when(size.isNull(), F.lit("unknown")).otherwise(result)
