"""Scalar column helpers. All are built-in Spark expressions (code-generated, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output formats.
DISPLAY_DATE = "MM/dd/yyyy"          # first-seen date shown as month/day/year
SHEET_DATE_INPUT = "M/d/yyyy"        # sheet dates: one-digit months and days accepted
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
MONEY_NOISE = r"[$,\s]"              # characters removed from scraped money text


NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asc(c) -> Column:
    """Ascending with NULLs last, the order the reference's engine uses."""
    return col(c).asc_nulls_last()


def desc(c) -> Column:
    """Descending with NULLs last."""
    return col(c).desc_nulls_last()


def f32(c) -> Column:
    return col(c).cast("float")


def f32_or_one(c) -> Column:
    """``coalesce(x::float, 1)`` kept in 32 bits (an untyped literal would widen to double)."""
    return F.coalesce(f32(c), F.lit(1.0).cast("float"))


def share(part, total, digits: int = 4) -> Column:
    """``part / total`` rounded; 0 when either side is missing or the total is 0."""
    ratio = F.try_divide(col(part).cast("double"), col(total).cast("double"))
    return F.coalesce(F.round(ratio, digits), F.lit(0.0))


def lenient_int(c) -> Column:
    """Text to INT the tolerant way: '1.6' -> 2, 'abc' -> NULL, out of range -> NULL. A number has
    decimal digits (single underscores between them) with an optional sign, point and
    exponent, or is written in base 16 or 2 ('0x1F', '0b11'); '1d' is none."""
    text = F.regexp_replace(col(c).cast("string"), r"(?<=\d)_(?=\d)", "")
    other = [F.conv(F.substring(text, 3, 32), base, 10).try_cast("int") for base in (16, 2)]
    return (F.when(text.rlike(NUMBER_TEXT), F.round(text.try_cast("double"), 0).try_cast("int"))
            .when(text.rlike("^0[xX][0-9a-fA-F]{1,16}$"), other[0])
            .when(text.rlike("^0[bB][01]{1,30}$"), other[1]))


def strict_int(c) -> Column:
    """Text to INT as ``lenient_int`` reads it, but text that is no number is an error. NULL
    stays NULL."""
    text = col(c).cast("string")
    return F.when(text.isNull() | lenient_int(c).isNotNull(), lenient_int(c)).otherwise(
        F.raise_error(F.concat(F.lit("not a number: "), text)).cast("int"))


def money_text_to_long(c) -> Column:
    """Scraped money text ('$1,234,567', '-', '') to BIGINT, unknown -> 0."""
    cleaned = F.regexp_replace(col(c).cast("string"), MONEY_NOISE, "")
    return F.coalesce(cleaned.try_cast("bigint"), F.lit(0).cast("bigint"))


def display_date(c) -> Column:
    return F.date_format(col(c), DISPLAY_DATE)


def days_until(start, as_of) -> Column:
    """Whole days from ``start`` to the as-of date (negative when ``start`` is later)."""
    return F.datediff(F.lit(as_of), col(start))
