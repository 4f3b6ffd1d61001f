"""Text expressions: row text, digests, charset reading, names and remarks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator between the columns of a row's text, the marker
# between a base table and its physical partition.
COLUMN_SEPARATOR = "~|~"
PARTITION_MARKER = "_1_prt_"

# The Windows-874 characters of bytes 0x80 to 0x9F that are
# defined. Thai letters follow from a rule, see `_windows_874`.
WINDOWS_874_SPECIALS = {
    0x80: "€",
    0x85: "…",
    0x91: "‘",
    0x92: "’",
    0x93: "“",
    0x94: "”",
    0x95: "•",
    0x96: "–",
    0x97: "—",
}
UNDEFINED = "�"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def name(column: str) -> Column:
    """The column called exactly ``column``, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def as_text(value: Column) -> Column:
    """The value as text, NULL as the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def row_text(values: list[Column]) -> Column:
    """All values of a row as one text; empty values keep their place."""
    return F.concat_ws(COLUMN_SEPARATOR, *[as_text(v) for v in values])


def exact_row_text(values: list[Column]) -> Column:
    """Row text in which no two different rows read the same.

    Every value carries its length, and NULL is written as ``-``.
    """
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws(COLUMN_SEPARATOR, *parts)


def digest(text: Column) -> Column:
    """MD5 of the text's UTF-8 bytes, as hex."""
    return F.md5(text.cast("binary"))


def _windows_874(byte: int) -> str:
    if byte in WINDOWS_874_SPECIALS:
        return WINDOWS_874_SPECIALS[byte]
    if byte == 0xA0:
        return " "
    if 0xA1 <= byte <= 0xDA or 0xDF <= byte <= 0xFB:
        return chr(0x0E00 + byte - 0xA0)
    return UNDEFINED


def reread_as_windows_874(text: Column) -> Column:
    """Read the UTF-8 bytes of the text as if they were Windows-874.

    ISO-8859-1 gives every byte a character of its own, so one ``translate``
    over the upper half finishes the work inside generated code. Bytes that
    Windows-874 leaves undefined become U+FFFD.
    """
    upper_half = range(0x80, 0x100)
    one_char_per_byte = F.decode(text.cast("binary"), "ISO-8859-1")
    return F.translate(
        one_char_per_byte,
        "".join(chr(b) for b in upper_half),
        "".join(_windows_874(b) for b in upper_half),
    )


def base_table(table: Column) -> Column:
    """The table a physical partition belongs to, or the table itself."""
    return F.substring_index(table, PARTITION_MARKER, 1)


def partition_suffix(table: Column) -> Column:
    """What follows the partition marker; NULL for a plain table."""
    return F.when(F.instr(table, PARTITION_MARKER) > 0, F.substring_index(table, PARTITION_MARKER, -1))


def last_name_part(qualified: Column) -> Column:
    """``schema.table`` -> ``table``."""
    return F.element_at(F.split(qualified, r"\."), -1)


def rewrite_path(path: Column, old: str | None, new: str | None) -> Column:
    """Replace ``old`` by ``new`` in a path, if both are given."""
    if not old or not new:
        return path
    return F.replace(path, F.lit(old), F.lit(new))


def without_quotes(text: Column) -> Column:
    """Logged texts carry no single quotes."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("'"), F.lit(""))


def on_one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"\r?\n", " ")


def shortened(text: Column, limit: int) -> Column:
    """The first ``limit`` characters, marked with dots when cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


# What a line gives a meaning, and how it reads in an escaped value. The escape
# character itself comes first when writing and last when reading.
ESCAPES = [(c, f"%{ord(c):02X}") for c in "%|,()\n\r"] + [("STATUS:", "STATUS%3A")]
GUARD = "%_"


def escaped(text: Column) -> Column:
    """The text with nothing in it that a line gives a meaning; blanks at its ends are guarded."""
    plain = text
    for char, code in ESCAPES:
        plain = F.replace(plain, F.lit(char), F.lit(code))
    return F.when(plain == strip(plain), plain).otherwise(F.concat(F.lit(GUARD), plain, F.lit(GUARD)))


def unescaped(text: Column) -> Column:
    """What `escaped` was given."""
    plain = F.replace(text, F.lit(GUARD), F.lit(""))
    for char, code in reversed(ESCAPES):
        plain = F.replace(plain, F.lit(code), F.lit(char))
    return plain


def separated(line: Column, separator: str) -> Column:
    """The fields of a line; one in double quotes may hold the separator, and a quote as two."""
    sep, quoted = re.escape(separator), r'"([^"]*(?:""[^"]*)*)"'
    field = rf"{sep}(?:\s*{quoted}\s*(?={sep}|$)|[^{sep}]*)"
    found = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(field), F.lit(0))

    def bare(part: Column) -> Column:
        inside = F.replace(F.regexp_extract(part, rf"^{sep}\s*{quoted}\s*$", 1), F.lit('""'), F.lit('"'))
        return F.when(part.rlike(rf"^{sep}\s*{quoted}\s*$"), inside).otherwise(F.substring(part, F.lit(2), F.length(part)))

    # Lines without a quote, nearly all, are split without a regular expression for each field.
    return F.when(F.contains(line, F.lit('"')), F.transform(found, bare)).otherwise(F.split(line, sep))
