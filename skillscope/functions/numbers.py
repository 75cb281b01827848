"""Column expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or exponent notation. Without this guard a cast to double also takes '12d'.
# Possessive, as no part can give back what it matched.
NUMBER_PATTERN = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"


def is_plain_number(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def plain_number(c: Column) -> Column:
    """Text to double; NULL for anything that is not a plain number (NaN and infinities too)."""
    return F.when(is_plain_number(c), c.try_cast("double"))


def midpoint(low: Column, high: Column) -> Column:
    """Middle of a range; a lone bound stands for itself, no bound gives NULL."""
    return F.coalesce((low + high) / F.lit(2.0), low, high)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient where a zero on either side means 'no value'."""
    zero = F.lit(0)
    return F.nullif(numerator, zero) / F.nullif(denominator, zero)
