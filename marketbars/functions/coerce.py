"""Numeric coercion: bad values become NULL (never NaN, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def to_double(x: Column) -> Column:
    return nan_to_null(x.try_cast("double"))


def to_bigint(x: Column) -> Column:
    """Whole-number coercion; fractional and non-finite inputs truncate or go NULL."""
    d = to_double(x)
    return F.when(d.isNotNull(), d.try_cast("bigint"))


def strike_to_int(x: Column) -> Column:
    """Strike -> INT the way ``int()`` does it: numbers truncate toward zero.

    -1 and NULL mean "no strike"; non-finite values are rejected.
    """
    d = to_double(x)
    return F.when(d.isNotNull() & (d != -1), d.try_cast("int"))
