"""Text expressions: trimming, the number grammar of table cells, parts of a file path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words read as a missing text cell.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Words read as an infinite number, in any letter case.
INFINITE_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")

_BLANKS = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: Column) -> Column:
    """Drop blanks of any kind, tabs included, from both ends."""
    return F.regexp_replace(text, f"^[{_BLANKS}]+|[{_BLANKS}]+$", "")


def numeric(cell: Column) -> Column:
    """A trimmed cell as a double; anything that is not a plain decimal number is NULL.

    A bare cast also takes ``1.0d``, ``1f``, hexadecimal floats and ``nan``: only text made of
    the characters of a decimal number is cast at all. Decimal text too large for a double is
    missing, not infinite; without an exponent, 300 characters cannot be too large.
    """
    value = cell.try_cast("double")
    return (
        F.when(cell.rlike("^[-+.0-9]{1,300}$"), value)
        .when(cell.rlike("^[-+.0-9eE]+$"), F.when(F.abs(value) < float("inf"), value))
        .when(F.lower(cell).isin(*INFINITE_WORDS), value)
    )


def whole_number(cell: Column) -> Column:
    """Whether a cell already known to be numeric is written without point or exponent."""
    return ~cell.contains(".") & ~cell.contains("e") & ~cell.contains("E") & ~F.lower(cell).contains("inf")


def text_value(cell: Column) -> Column:
    """A trimmed text cell; a run of ``#`` or a word for missing is NULL."""
    return F.when(~(cell.isin(*MISSING_WORDS) | cell.rlike("^#+$")), cell)


def folder_name(path: Column, levels: int = 1) -> Column:
    """The last ``levels`` folders above the file of a plain path."""
    return F.substring_index(F.substring_index(path, "/", -1 - levels), "/", levels)


def decoded(url: Column) -> Column:
    """A file URL as plain text; ``+`` is itself, not a blank."""
    return F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))


def bad_header(header: Column) -> Column:
    """Whether a header line gives no layout: it is blank, or names a channel twice."""
    names = F.split(F.trim(F.regexp_replace(header, r"\s", " ")), " +")
    return (F.trim(F.regexp_replace(header, r"\s", " ")) == "") | (F.size(F.array_distinct(names)) < F.size(names))
