"""Column-level coercions (NULL-safe, ANSI-safe: every cast is a ``try_`` cast).

Each function maps Columns to a Column, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = str | Column

# FIXED VALUES: the characters Python's str.strip() removes (str.isspace()).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(c: ColLike) -> Column:
    """Python ``str.strip()``: ``btrim`` with the Unicode whitespace set (no regex)."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def clean_text(c: ColLike) -> Column:
    """Value as trimmed text; NULL, NaN and blank become NULL."""
    col = _c(c)
    s = strip(col)
    return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(F.nullif(s, F.lit("")))


def opt_str(c: ColLike) -> Column:
    """Same rule as ``clean_text`` for statement metadata."""
    return clean_text(c)


def to_date10(c: ColLike) -> Column:
    """A date from the first 10 characters in ISO form (YYYY-MM-DD), else NULL.

    DATE and TIMESTAMP inputs keep their calendar date.
    """
    col = _c(c)
    s = F.substring(col.cast("string"), 1, 10)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date"))


def to_dec(c: ColLike, precision: int = 20, scale: int = 4) -> Column:
    """Decimal from text or number; NULL when not a number."""
    return strip(c).try_cast(f"decimal({precision},{scale})")


def to_int(c: ColLike) -> Column:
    """Integer part (toward zero) of a decimal reading of the value."""
    return strip(c).try_cast("decimal(38,10)").try_cast("bigint")


def opt_int(c: ColLike) -> Column:
    """int(float(x)): '1.9' -> 1, 'bad' -> NULL, NaN -> NULL."""
    d = strip(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("bigint")).otherwise(d.try_cast("bigint"))


def extract_numeric(c: ColLike) -> Column:
    """Numeric statement value truncated toward zero to BIGINT (EPS 6.13 -> 6).

    Non-numeric text, NaN and infinities give NULL.
    """
    d = _c(c).cast("string").try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None).cast("bigint")).otherwise(
        d.try_cast("bigint"))


def epoch_to_date(c: ColLike) -> Column:
    """Epoch seconds -> DATE (UTC); NULL for missing, non-numeric or <= 0."""
    n = _c(c).cast("string").try_cast("bigint")
    return F.when(n > 0, F.to_date(F.timestamp_seconds(n)))


def first_of(df: DataFrame, *names: str) -> Column:
    """First non-missing value among the alias columns that exist."""
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None)
    cols = []
    for n in present:
        dt = df.schema[n].dataType.typeName()
        c = F.col(n)
        if dt in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        cols.append(c)
    return F.coalesce(*cols) if len(cols) > 1 else cols[0]


def form_type(c: ColLike) -> Column:
    """P16: 'Form 4/A' -> '4/A' (every 'Form' removed, then trimmed); NULL -> ''."""
    col = _c(c)
    return F.when(col.isNull() | (col == ""), F.lit("")).otherwise(strip(F.replace(col, F.lit("Form"), F.lit(""))))


def is_amendment(form: ColLike) -> Column:
    return _c(form).endswith("/A")


def fiscal_period_end(d: ColLike, is_annual: ColLike) -> Column:
    """Annual -> 31 Dec of the year; quarterly -> end of the calendar quarter."""
    dd = _c(d).cast("date")
    q_end = F.last_day(F.add_months(F.trunc(dd, "quarter"), 2))
    return F.when(_c(is_annual), F.make_date(F.year(dd), F.lit(12), F.lit(31))).otherwise(q_end)


def fiscal_quarter(d: ColLike, is_annual: ColLike) -> Column:
    return F.when(~_c(is_annual), F.quarter(_c(d).cast("date")))


def period_type(is_annual: ColLike) -> Column:
    return F.when(_c(is_annual), F.lit("annual")).otherwise(F.lit("quarterly"))
