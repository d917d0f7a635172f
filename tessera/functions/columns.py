"""Scalar column rules of the cleaned and star layers.

Every rule is a built-in Spark expression, so it stays inside whole-stage
codegen; none of them needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed value: the label that replaces a missing or blank text value.
UNKNOWN = "UNKNOWN"

AMOUNT_TYPE = DecimalType(18, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_or_null(c: Column | str) -> Column:
    """NULL, empty, or spaces only.  ``trim`` strips spaces, not tabs/newlines."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def clean_label(c: Column | str) -> Column:
    """Trimmed text; NULL or blank becomes ``UNKNOWN``."""
    c = _col(c)
    return F.when(blank_or_null(c), F.lit(UNKNOWN)).otherwise(F.trim(c))


def clean_region(c: Column | str) -> Column:
    """Upper-cased trimmed text; NULL or blank becomes ``UNKNOWN``."""
    c = _col(c)
    return F.when(blank_or_null(c), F.lit(UNKNOWN)).otherwise(F.upper(F.trim(c)))


def clean_label_basic(c: Column | str, upper: bool = False) -> Column:
    """The first, CSV-era rule: only NULL becomes ``UNKNOWN``; text is trimmed
    (and upper-cased for regions), so a blank value stays ``''``."""
    c = _col(c)
    t = F.upper(F.trim(c)) if upper else F.trim(c)
    return F.when(c.isNull(), F.lit(UNKNOWN)).otherwise(t)


def date_key(d: Column | str) -> Column:
    """``yyyyMMdd`` as an int, computed arithmetically (no string round trip)."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def sale_amount(quantity: Column | str, unit_price: Column | str) -> Column:
    """``round(quantity * unit_price, 2)`` as decimal(18,2).

    ``try_cast`` keeps the non-ANSI outcome (NULL) for a NaN or an amount that
    does not fit, instead of failing the whole job under ANSI mode.
    """
    return F.round(_col(quantity) * _col(unit_price), 2).try_cast(AMOUNT_TYPE)
