"""Numbers out of free text, and rounding that agrees across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or exponent notation, blanks around it allowed.  Keeps out what a
# JVM cast would let through: type suffixes (100f), NaN and Infinity.
NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

#: Doubles of this size and more are whole numbers.
EXACT = float(2**53)


def try_real(text: Column) -> Column:
    """Text to float, NULL when it is not a number."""
    return F.when(text.rlike(NUMBER), text.try_cast("float"))


def try_int(text: Column) -> Column:
    """Text to int, rounding decimals and exponents; NULL when it does not fit."""
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    rounded = F.signum(number) * F.floor(F.abs(number) + F.lit(0.5))
    return rounded.try_cast("int")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Round half away from zero in plain double arithmetic.

    Spelled out because engines disagree on the built-in (1.005 gives 1.0 or 1.01).
    """
    scale = float(10**digits)
    x = value.cast("double")
    rounded = F.signum(x) * whole_part(F.abs(x) * scale + F.lit(0.5)) / F.lit(scale)
    # From 2**53 units on a double has no digits left to round.
    return F.when(F.abs(x) * scale >= F.lit(EXACT), x).otherwise(rounded)


def whole_part(x: Column) -> Column:
    """Floor of a double as a double; the built-in one gives a bigint, which saturates."""
    return F.when(F.abs(x) >= F.lit(EXACT), x).otherwise(F.floor(x).cast("double"))


def percent_change(now: Column, before: Column, kind: str = "double") -> Column:
    """Relative change in percent; NULL without a usable earlier value.

    `kind` is the precision that the arithmetic is carried out in.
    """
    ratio = F.try_divide((now - before).cast(kind), before.cast(kind)).cast(kind)
    return ratio * F.lit(100).cast(kind)
