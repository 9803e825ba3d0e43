"""Exact price arithmetic.

Prices are ``decimal(18,6)`` and travel as integer *units* (millionths of the currency):
sums of units are exact, rolling means compare exactly (``4*sum10 > sum40``) and the
displayed mean is one IEEE division of an exact integer, which any engine reproduces bit
for bit.  A price with more than six decimals is rejected where it is parsed, never rounded.

Prices of more than ``MAX_PRICE`` either way are rejected with a reason, in lines (``bad_range``) and in tables
(``out_of_range``) alike: up to it, the sums and products of the moving averages stay in 64 bits.  Sums over windows,
which any number of rows may enter, are decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timefmt import py_datetime_str

PRICE_TYPE = "decimal(18,6)"
UNITS = 1_000_000  # units of one currency unit
MAX_PRICE = 1_000_000_000
MAX_UNITS = MAX_PRICE * UNITS
# Fixed values of the trading rule: a $100,000 budget per signal.
BUDGET_UNITS = 100_000 * UNITS


def units(price: Column) -> Column:
    """Price -> bigint units; null for a null price."""
    return (price.cast(PRICE_TYPE) * UNITS).cast("bigint")


def wide(units_col: Column) -> Column:
    """Units for sums over any number of rows."""
    return units_col.cast("decimal(28,0)")


def fits_long(factor: int) -> bool:
    """Whether ``factor`` times the largest units stays in 64 bits."""
    return factor * MAX_UNITS < 1 << 63


def price_of(price_units: Column) -> Column:
    """Units -> the exact decimal price."""
    return (price_units.cast("decimal(24,0)") / UNITS).cast(PRICE_TYPE)


def price_text(price: Column) -> Column:
    """``185.50``, ``0.004``: at least two decimals, no further trailing zeros."""
    return F.regexp_replace(price.cast(PRICE_TYPE).cast("string"), "0{1,4}$", "")


def shares_for_budget(price_units: Column, budget_units: int = BUDGET_UNITS) -> Column:
    """Whole shares the budget buys (truncation, like int(100000 / price)); null if price <= 0."""
    return F.when(price_units > 0, F.call_function("div", F.lit(budget_units).cast("bigint"), price_units))


def signal_message(ts: Column, side: Column, symbol: Column, shares: Column, price_units: Column) -> Column:
    """``(2024-01-02 09:30:00 buy AAPL) - 539 shares at $185.50``."""
    return F.format_string("(%s %s %s) - %d shares at $%s", py_datetime_str(ts), side, symbol.cast("string"), shares,
                           price_text(price_of(price_units)))
