"""Small Column helpers shared by all function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def falsy(c) -> Column:
    """PHP ``empty()`` / ``?:`` test on a string: NULL, '' and '0' are empty."""
    c = col(c)
    return c.isNull() | (c == F.lit("")) | (c == F.lit("0"))


def elvis(x, y) -> Column:
    """PHP ``x ?: y``: y when x is falsy, else x (not ``coalesce``)."""
    return F.when(falsy(x), col(y)).otherwise(col(x))


def empty_to_null(c) -> Column:
    c = col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


# PHP trim() default character set: space, tab, LF, CR, NUL, vertical tab.
PHP_TRIM_CHARS = " \t\n\r\x00\x0b"


def php_trim(c) -> Column:
    return F.btrim(col(c), F.lit(PHP_TRIM_CHARS))


def php_ltrim(c, chars: str = PHP_TRIM_CHARS) -> Column:
    return F.ltrim(col(c), F.lit(chars))


def php_rtrim(c, chars: str = PHP_TRIM_CHARS) -> Column:
    return F.rtrim(col(c), F.lit(chars))


def byte_len(c) -> Column:
    """PHP ``strlen``: length in bytes (UTF-8), not characters."""
    return F.octet_length(col(c))
