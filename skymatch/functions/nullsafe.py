"""Comparisons and divisions that keep the rules of array programs: NaN compares false, division never raises."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN, INF = float("nan"), float("inf")


def known(c: Column) -> Column:
    """Neither null nor NaN."""
    return c.isNotNull() & ~F.isnan(c)


def finite(c: Column) -> Column:
    return known(c) & (F.abs(c) < INF)


def ieee_div(a: Column, b: Column) -> Column:
    """a / b with x/0 as signed infinity and 0/0 as NaN; null stays null."""
    a, b = a.cast("double"), b.cast("double")
    zero = F.when(F.isnan(a) | (a == 0), NAN).when(a > 0, INF).otherwise(-INF)
    return F.when(a.isNull() | b.isNull(), None).when(b == 0, zero).otherwise(a / F.when(b == 0, 1.0).otherwise(b))


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def lt(a: Column, b) -> Column:
    """a < b, false where either is null or NaN."""
    return _sure(~F.isnan(a) & (a < b))


def le(a: Column, b) -> Column:
    return _sure(~F.isnan(a) & (a <= b))


def ge(a: Column, b) -> Column:
    """a >= b, false where ``a`` is null or NaN (Spark sorts NaN above everything)."""
    return _sure(~F.isnan(a) & (a >= b))


def any_flag(flags: Iterable[Column], null_as: bool) -> Column:
    """Whether any flag is set; a null flag counts as ``null_as``."""
    return reduce(lambda x, y: x | y, (F.coalesce(f, F.lit(null_as)) for f in flags), F.lit(False))


def null_if(c: Column, value) -> Column:
    return F.when(c != value, c)
