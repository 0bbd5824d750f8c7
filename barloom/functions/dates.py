"""Column expressions over dates and market time.

The wall clock is never read here: the moment of a run is always an argument.
"""

from datetime import datetime

from pyspark.sql import Column, functions as F

from barloom.schema import EOD_HOUR, EOD_MINUTE, MARKET_ZONE


def moment(as_of: datetime) -> Column:
    """A local market time as TIMESTAMP_NTZ, whatever zone Python or the session is in."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_trading_date(col: Column) -> Column:
    """``yyyyMMdd`` text to a date; unparsable text becomes null."""
    return F.try_to_date(col, "yyyyMMdd")


def event_date(col: Column) -> Column:
    """Date part of an ISO timestamp text; unparsable text becomes null."""
    return F.try_to_date(F.substring(col.cast("string"), 1, 10), "yyyy-MM-dd")


def epoch_ms_to_market_date(col: Column, zone: str = MARKET_ZONE) -> Column:
    """Calendar date in the market's zone, whatever the session time zone is."""
    return F.convert_timezone(None, F.lit(zone), F.timestamp_millis(col)).cast("date")


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def is_eod(day: Column, as_of: Column) -> Column:
    """True when ``day`` is closed at ``as_of``, a local market TIMESTAMP_NTZ."""
    closing = EOD_HOUR * 60 + EOD_MINUTE
    minutes = F.hour(as_of) * 60 + F.minute(as_of)
    return (day < as_of.cast("date")) | (minutes >= closing)


def parse_run_date(col: Column) -> Column:
    """Date of the last run as stored; anything unparsable counts as no run."""
    return F.try_to_date(col.cast("string"), "yyyy-M-d")


def run_decision(t0_max: Column, last_run: Column, eod: Column) -> Column:
    """``stop_older``, ``stop_done``, ``rerun`` or ``run``."""
    closed = F.coalesce(eod, F.lit(False))
    return (
        F.when(last_run.isNull(), "run")
        .when(t0_max < last_run, "stop_older")
        .when((t0_max == last_run) & closed, "stop_done")
        .when(t0_max == last_run, "rerun")
        .otherwise("run")
    )


def days_between_runs(last_run: Column, eod: Column, t0_max: Column) -> Column:
    """Array of days from the last run up to, not including, ``t0_max``.

    The day of the last run itself is included when it was not closed. Null when
    there was no last run or nothing lies between.
    """
    start = F.date_add(last_run, F.when(F.coalesce(eod, F.lit(False)), 1).otherwise(0))
    end = F.date_sub(t0_max, 1)
    return F.when(start <= end, F.sequence(start, end))
