"""Guarded casts and date logic.

Spark 4 runs with ANSI casts that raise; the reference pipeline aborted a whole
query on one bad value.  Here every cast sits behind the same regex test and is
a ``try_cast``: a bad value gives NULL (or the documented default) for that
value only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions.text import matches

DEC_RENT = "decimal(18,4)"
DEC_COORD = "decimal(18,10)"
DEC_AMOUNT = "decimal(18,4)"
DEC_GMD = "decimal(24,6)"
DEC_TAX_ROW = "decimal(27,8)"
DEC_SUM_GMD = "decimal(38,6)"
DEC_SUM_TAX = "decimal(38,8)"


def as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(str(d)).cast("date")


def as_ts(t) -> Column:
    if isinstance(t, Column):
        return t
    if isinstance(t, dt.date) and not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    return F.lit(str(t)).cast("timestamp_ntz")


def guarded(c: Column, pattern: str, to_type: str) -> Column:
    """``CASE WHEN c ~ pattern THEN try_cast(c AS to_type) END``."""
    return F.when(matches(c, pattern), c.try_cast(to_type))


def strict_date(c: Column) -> Column:
    """``yyyy-mm-dd`` only, then a checked cast (2024-02-30 -> NULL)."""
    return guarded(c, K.DATE_RE, "date")


def prefix_date(c: Column) -> Column:
    """Leading ``yyyy-mm-dd``, time part ignored."""
    return F.when(matches(c, K.DATE_PREFIX_RE), F.substring(c, 1, 10).try_cast("date"))


def prefix_timestamp(c: Column) -> Column:
    """Leading ``yyyy-mm-dd`` then the whole text as a zone-less timestamp (zone dropped)."""
    return F.when(matches(c, K.DATE_PREFIX_RE), c.try_cast("timestamp_ntz"))


def units_in_range(c: Column) -> Column:
    v = c.try_cast("int")
    return (F.when(matches(c, K.UNITS_RE) & v.between(K.UNITS_MIN, K.UNITS_MAX), v)
            .otherwise(F.lit(K.UNITS_DEFAULT)))


def coord_in_range(c: Column, lo, hi) -> Column:
    v = c.try_cast(DEC_COORD)
    return F.when(matches(c, K.COORD_RE) & v.between(F.lit(lo), F.lit(hi)), v)


def rent_amount(c: Column) -> Column:
    """Numeric text, > 0 and <= 10,000,000 in the stated currency, else 0."""
    v = c.try_cast(DEC_RENT)
    return (F.when(matches(c, K.RENT_RE) & (v > 0) & (v <= F.lit(K.RENT_MAX)), v)
            .otherwise(F.lit(0).cast(DEC_RENT)))


def amount_paid(c: Column) -> Column:
    v = c.try_cast(DEC_AMOUNT)
    return F.when(matches(c, K.AMOUNT_RE) & (v >= 0), v).otherwise(F.lit(0).cast(DEC_AMOUNT))


def plan_amount(c: Column) -> Column:
    return guarded(c, K.AMOUNT_RE, DEC_AMOUNT)


def dob_valid(c: Column, as_of) -> Column:
    d = c.try_cast("date")
    return F.when(matches(c, K.DATE_RE) & (d <= as_date(as_of)) & (d >= F.lit(K.DOB_MIN).cast("date")), d)


def age_years(dob: Column, as_of) -> Column:
    """Whole calendar years between ``dob`` and ``as_of`` (born 2000-02-29 is 22 on 2023-02-28)."""
    a = as_date(as_of)
    before_birthday = (F.date_format(a, "MMdd") < F.date_format(dob, "MMdd")).cast("int")
    return (F.year(a) - F.year(dob) - before_birthday).cast("int")


def age_from_text(c: Column, as_of) -> Column:
    d = c.try_cast("date")
    return F.when(matches(c, K.DATE_RE) & (d <= as_date(as_of)), age_years(d, as_of))
