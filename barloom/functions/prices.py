"""Column expressions over prices and volumes."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from barloom.schema import (
    PRICE_ADJ,
    PRICE_COLS,
    PRICE_FACTOR,
    SYMBOL_PATTERN,
    UNIT_THRESHOLD,
)

_INF = float("inf")


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def finite_or_null(col: Column) -> Column:
    """NaN and the infinities become null. NaN sorts above every number in Spark."""
    return F.when(F.abs(col) < _INF, col)


def has_finite_prices() -> Column:
    return all_of(F.abs(F.col(c)) < _INF for c in PRICE_COLS)


def invalid_bar() -> Column:
    """True for a bar that contradicts itself, null when that cannot be decided.

    Use it as ``filter(~invalid_bar())``, which also drops the undecidable rows.
    """
    o, h, l, c = (F.col(name) for name in PRICE_COLS)
    high_is_not_top = (h < l) | (h < o) | (h < c)
    low_is_not_bottom = (l > o) | (l > c)
    not_positive = (o <= 0) | (h <= 0) | (l <= 0) | (c <= 0)
    return high_is_not_top | low_is_not_bottom | not_positive | (F.col("total_volume") < 0)


def contract_rules() -> dict[str, Column]:
    """Rule name to the condition a good row meets (null counts as a breach)."""
    o, h, l, c = (F.col(name) for name in PRICE_COLS)
    rules = {"symbol_format": F.col("symbol").rlike(SYMBOL_PATTERN)}
    rules["trading_date_present"] = F.col("trading_date").isNotNull()
    for name in PRICE_COLS:
        rules[f"{name}_positive"] = F.col(name) > 0
    rules["total_volume_not_negative"] = F.col("total_volume") >= 0
    rules["exchange_present"] = F.col("exchange").isNotNull()
    rules["source_present"] = F.col("source").isNotNull()
    rules["high_ge_low"] = h >= l
    rules["high_ge_open"] = h >= o
    rules["high_ge_close"] = h >= c
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def low_rules() -> dict[str, Column]:
    """Two extra rules the strict contract leaves out; they are reported only."""
    low = F.col("low_price")
    return {
        "low_le_open": F.coalesce(low <= F.col("open_price"), F.lit(False)),
        "low_le_close": F.coalesce(low <= F.col("close_price"), F.lit(False)),
    }


def scale_price(col: Column, factor=PRICE_FACTOR) -> Column:
    return F.round(col * F.lit(factor), 2)


def to_volume(col: Column) -> Column:
    """Volume text as BIGINT, exact also above 2**24; a fraction is cut off."""
    return F.coalesce(
        col.try_cast("bigint"), col.try_cast("decimal(38,6)").try_cast("bigint")
    )


def average_of_prices() -> Column:
    return sum((F.col(c) for c in PRICE_COLS[1:]), F.col(PRICE_COLS[0])) / F.lit(4.0)


def unit_factor(price: Column) -> Column:
    """1000 for a price quoted in thousands, 1 otherwise, null for no usable price."""
    usable = (price > 0) & (F.abs(price) < _INF)
    return F.when(usable, F.when(price < UNIT_THRESHOLD, 1000.0).otherwise(1.0))


def raw_price(col: Column) -> Column:
    return F.round(col, 0).cast("bigint")


def adjusted_price(col: Column) -> Column:
    return F.round(col, 2).cast(PRICE_ADJ)
