"""Load of the full history, and back-filling single days from daily archives."""

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from barloom.functions import dates
from barloom.operators import calendar, clean, snapshot
from barloom.operators.keyed import landed
from barloom.schema import BAR_COLS
from barloom.sinks.bar_table import BarTable
from barloom.sinks.run_state import RunState, version_of
from barloom.sources.archive_source import ArchiveFolder, scan
from barloom.sources.archives import archive_day, archive_order


def history_load(
    files: DataFrame | ArchiveFolder,
    source: str,
    blacklist: DataFrame | None = None,
    day: date | None = None,
    kind: str = "raw",
    until: date | None = None,
) -> DataFrame:
    """Clean, unique bars of all archives of one ``kind``; on request only those of one day.

    Prices as traded and adjusted ones are never mixed. ``until`` reads the newest archive up to that day alone.

    Of repeated bars the one of the latest archive, by the day in its name, is kept; then
    entry and line order decide.
    """
    bars = clean.clean_history(scan(files, kind, until=until), source, blacklist)
    if day is not None:
        bars = clean.day_slice(bars, day)
    return clean.dedup_bars(bars, *archive_order(), keep=BAR_COLS)


def backfill(
    files: DataFrame | ArchiveFolder,
    days: list[date],
    source: str,
    blacklist: DataFrame | None = None,
    kind: str = "raw",
) -> DataFrame:
    """For each wanted day the bars of that day from that day's own archive.

    All archives are read in one job. Archives of other days or another kind are left
    out by their name; as the days are literals, files are not even opened for it.
    """
    bars = clean.clean_history(scan(files, kind, sorted(set(days))), source, blacklist)
    own = bars.filter(F.col("trading_date") == archive_day(F.col("archive")))
    return clean.dedup_bars(own, *archive_order(), keep=BAR_COLS)


def unfilled_days(days: DataFrame, filled: DataFrame) -> DataFrame:
    """Wanted days without any bar, to be reported."""
    return calendar.absent_days(days.select("trading_date").distinct(), filled)


def run_history(
    files: DataFrame | ArchiveFolder,
    table: BarTable,
    source: str,
    as_of: datetime,
    state: RunState | None = None,
    blacklist: DataFrame | None = None,
    day: date | None = None,
    kind: str = "raw",
    until: date | None = None,
) -> DataFrame:
    """Load the history into ``table``, or one day of it, and return the bars.

    As archives are cumulative, ``until`` reads the newest one up to that day alone.

    With ``state`` given the end-of-day snapshot is updated as well.
    """
    spark = files.sparkSession
    bars = landed(history_load(files, source, blacklist, day, kind, until), "history")
    if bars.isEmpty():
        raise ValueError("no bar is left after cleaning; the table was not changed")
    if day is None:
        table.truncate_load(bars)
    else:
        table.replace_date(bars, day)
    if state is not None:
        moment = dates.moment(as_of)
        new = landed(snapshot.eod_snapshot(bars, state.snapshot(spark), moment), "snapshot")
        pending = snapshot.inherit_pending(None, state.pending(spark))
        state.save(snapshot.run_metadata(bars, new, moment), pending, new, version_of(as_of))
    return bars
