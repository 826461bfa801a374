"""Sums and rounded results of amounts.

A distributed sum of doubles changes in its last bits with the partitioning, so a total that lies on
half a cent may round either way. Amounts that are declared to have a fixed number of places (cents,
or the sixth place for computed ones) are therefore added exactly, as two long sums: whole units and
the rest in units of the last place. That stays inside generated code; decimals appear only after the
aggregation. What amounts have beyond these places, but for the error of a double, is added as a plain
sum of doubles and joins the result, so nothing is cut off; it is exactly 0 where the declaration holds.
``off_scale`` counts the amounts that break it. ``total_of`` is the plain sum of the doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 6
WHOLE = "decimal(20,0)"


def _value(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def exact_sum(amount: Column | str, places: int = PLACES) -> Column:
    """Sum, as a decimal, of amounts declared to have at most ``places`` places.

    Amounts with more places are added too, beyond these places as doubles. Amounts beyond a long, or
    NaN, raise an error.
    """
    value = _value(amount)
    units = value.cast("bigint")
    scaled = (value - units) * 10**places
    last = F.rint(scaled)
    # A double is that far from the amount it stands for; more is a real part of the amount.
    noise = F.greatest(F.lit(1e-9), F.abs(value) * (10**places * 2.0**-51))
    beyond = F.when(F.abs(scaled - last) > noise, scaled - last).otherwise(0.0)
    exact = F.sum(units).cast(WHOLE) + F.sum(last.cast("bigint")).cast(WHOLE) * F.lit(Decimal(1).scaleb(-places))
    return exact + (F.sum(beyond) / 10**places).cast(f"decimal(20,{places})")


def off_scale(amount: Column | str, places: int = PLACES) -> Column:
    """How many amounts are not a multiple of the last place, beyond the error of a double."""
    value = _value(amount)
    scaled = value * 10**places
    return F.count_if(F.abs(scaled - F.rint(scaled)) > F.greatest(F.lit(1e-9), F.abs(scaled) * 1e-12))


def total_of(amount: Column | str) -> Column:
    """Unrounded sum of doubles, whatever their scale."""
    return F.sum(_value(amount).cast("double"))


def sum_of(amount: Column | str, digits: int = 2) -> Column:
    """Sum, rounded half up."""
    return F.round(exact_sum(amount), digits).cast("double")


def mean_of(amount: Column | str, digits: int = 2) -> Column:
    """Average of the non-null amounts, rounded half up."""
    return F.round(quotient(exact_sum(amount), F.count(amount)), digits).cast("double")


def quotient(total: Column, count: Column) -> Column:
    """Decimal division, with more places than are shown, so that rounding it again is safe."""
    return F.try_divide(total.cast("decimal(30,6)"), count.cast("decimal(14,0)"))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` of two integers, rounded half up; NULL for an empty whole."""
    return F.round(F.try_divide(part.cast(WHOLE), whole.cast(WHOLE)), digits).cast("double")
