"""Column expressions over symbols, exchanges and lists of symbols."""

from pyspark.sql import Column, functions as F

from barloom.schema import (
    DEFAULT_EVENT_CODE,
    MISSING_TICKERS,
    REPORT_MORE,
    REPORT_NONE,
    REPORT_SHOWN,
    TICKER_PATTERN,
)

# Fixed value: the Unicode White_Space characters, in code point order.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Trim all Unicode whitespace; plain ``trim`` would only trim blanks."""
    return F.trim(col.cast("string"), F.lit(WHITESPACE))


def normalize_symbol(col: Column) -> Column:
    return F.upper(strip(col))


def normalize_exchange(col: Column) -> Column:
    """Exchange code or file name to its label; the first match wins."""
    code = normalize_symbol(col)
    return (
        F.when(code.contains("HSX") | code.contains("HOSE"), "HoSE")
        .when(code.contains("UPCOM"), "UPCoM")
        .when(code.contains("HNX"), "HNX")
        .otherwise("Unknown")
    )


def event_symbol(ticker: Column, organ_code: Column) -> Column:
    """Ticker of a corporate event, or its organisation code when absent."""
    clean = normalize_symbol(ticker)
    missing = ticker.isNull() | clean.isin(MISSING_TICKERS)
    return F.coalesce(F.when(missing, normalize_symbol(organ_code)).otherwise(clean), F.lit(""))


def event_type(code: Column) -> Column:
    return F.coalesce(code.cast("string"), F.lit(DEFAULT_EVENT_CODE))


def is_ticker(col: Column) -> Column:
    return col.rlike(TICKER_PATTERN)


def shown_symbols(first: Column, total: Column, shown: int = REPORT_SHOWN) -> Column:
    """Text for a report: the first symbols, then how many more there are.

    ``first`` is an array of at most ``shown`` symbols, ``total`` the full count.
    """
    before, after = REPORT_MORE.split("{}")
    listed = F.array_join(first, ", ")
    more = F.concat(F.lit(before), (total - shown).cast("string"), F.lit(after))
    return (
        F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(REPORT_NONE))
        .when(total <= shown, listed)
        .otherwise(F.concat(listed, more))
    )
