"""Price, discount and rating text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagledger.functions.text import strip_text

# The currency sign and the thousands separator of price text.
CURRENCY_SIGN = "₹"
THOUSANDS_SEPARATOR = ","

# Doubles from here on are whole numbers.
NO_CENTS = float(1 << 52)

_NUMBER = r"(?i)^[+-]?(?:[0-9]+\.?[0-9]*(?:e[+-]?[0-9]+)?|\.[0-9]+(?:e[+-]?[0-9]+)?|nan|inf|infinity)$"


def _to_double(text: Column) -> Column:
    """Null unless the whole text is a number; a type suffix such as ``1d`` is not one."""
    bare = strip_text(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def parse_price(text: Column) -> Column:
    """``'₹97,999'`` to ``97999.0``; empty or bad text to null."""
    bare = F.replace(F.replace(text, F.lit(CURRENCY_SIGN), F.lit("")), F.lit(THOUSANDS_SEPARATOR), F.lit(""))
    return _to_double(bare)


def parse_discount(text: Column) -> Column:
    """``'7%'`` to ``7``; a fraction such as ``'7.5%'`` is bad text."""
    bare = strip_text(F.replace(text, F.lit("%"), F.lit("")))
    return F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("int"))


def parse_rating(text: Column) -> Column:
    """``'4.15'`` to ``4.15``; bad text to null."""
    return _to_double(text)


def round2(value: Column) -> Column:
    """Two decimals, halves up, by ``floor``.

    Gives the same double in every SQL engine.  On an exact tie it can differ
    by one cent from rounding that looks at the binary value of the double.
    NaN, and what is too large to have cents, stays as it is.
    """
    rounded = F.floor(value * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)
    return F.when(F.isnan(value) | (F.abs(value) >= NO_CENTS), value).otherwise(rounded)


def mrp_from_discount(price: Column, pct: Column) -> Column:
    """List price before the discount; null without price or discount, and at 100 %."""
    known = (price != 0) & (pct != 0)
    share = F.lit(1.0) - pct / F.lit(100.0)
    return F.when(known, round2(F.try_divide(price, share)))
