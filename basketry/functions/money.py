"""Money arithmetic: sums that don't depend on row order, guarded ratios, rounding.

Amounts are doubles, as in the source model, but a sum of doubles depends on the
order rows arrive in: a retried task or a partial refresh would change last
digits and break ranking ties. Sums therefore run over decimals with ``SCALE``
digits after the point, which keeps hash aggregation and raises on overflow
(an amount from 1e14, a sum from 1e24 units of currency) instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE = 10


def as_decimal(amount: Column) -> Column:
    return amount.cast(f"decimal(24,{SCALE})")


def as_double(total: Column) -> Column:
    return total.cast("double")


def exact_sum(amount: Column) -> Column:
    return as_double(F.sum(as_decimal(amount)))


def exact_avg(amount: Column) -> Column:
    return F.try_divide(exact_sum(amount), F.count(amount).cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when the whole is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def round_half_away(value: Column, digits: int = 2) -> Column:
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale
