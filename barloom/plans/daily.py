"""The daily update: board, missed days, corporate actions, adjusted history.

``daily_frames`` declares the whole run as DataFrames. ``run_daily`` writes them
in the order raw, adjusted, state, so that a run that broke off can be repeated.
"""

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions import dates
from barloom.operators import adjust, calendar, clean, contract, events, report, snapshot
from barloom.operators import symbols as universe
from barloom.operators import units
from barloom.operators.keyed import landed
from barloom.plans.history import backfill, unfilled_days
from barloom.schema import (
    BAR_COLS,
    BOARD_EXTRA_COLS,
    DEFAULT_BENCHMARKS,
    HISTORY_START,
    MOST_ABSENT_SHARE,
    MOST_BROKEN_SHARE,
)
from barloom.sinks.bar_table import BarTable, sink_symbol_history
from barloom.sinks.history_feed import BucketedHistory
from barloom.sinks.run_state import RunState, version_of
from barloom.sources.archive_source import ArchiveFolder
from barloom.sources.feeds import require_sound


@dataclass(frozen=True)
class DailyFeeds:
    """Landed inputs of a run, as the readers in ``barloom.sources`` return them.

    ``broken`` has the counts of ``feeds.broken_lines`` of the JSON feeds.
    """

    listing: DataFrame
    board: DataFrame
    history: DataFrame | BucketedHistory
    events: DataFrame
    holidays: DataFrame
    archives: DataFrame | ArchiveFolder
    broken: DataFrame | None = None


@dataclass(frozen=True)
class DailySettings:
    """``force`` runs on a closed day too. The run stops if more than ``most_absent`` of the
    listed symbols are not on the board, or more than ``most_broken`` of a feed's lines are broken;
    ``archive_kind`` picks raw or adjusted archives."""

    as_of: datetime
    source: str = "vci"
    archive_source: str = "archive"
    benchmarks: tuple[str, ...] = tuple(DEFAULT_BENCHMARKS)
    history_start: str = HISTORY_START
    blacklist: DataFrame | None = None
    custom_holidays: DataFrame | None = None
    force: bool = False
    most_absent: float = MOST_ABSENT_SHARE
    most_broken: float = MOST_BROKEN_SHARE
    archive_kind: str = "raw"
    history_buckets: int | None = 16


def board_bars(board: DataFrame, source: str, multiplier) -> DataFrame:
    """Board rows to checked bars in the right unit, one per symbol and day.

    The contract is checked before the unit is changed.
    """
    cleaned = contract.enforce_contract(clean.clean_board(board, source))
    unique = clean.dedup_bars(cleaned, F.col("time"), F.col("total_volume"))
    return clean.apply_multiplier(unique.drop("time"), multiplier, BOARD_EXTRA_COLS)


def run_daily(
    spark: SparkSession,
    feeds: DailyFeeds,
    raw: BarTable,
    adjusted: BarTable,
    state: RunState,
    reloaded_path: str,
    settings: DailySettings,
) -> DataFrame | None:
    """Run one day and return its report, or None when there is nothing to do.

    Only the run decision, the list of missing days and the two unit factors come
    to the driver; all of them are small whatever the number of bars.
    """
    moment = dates.moment(settings.as_of)
    version = version_of(settings.as_of)
    holidays = landed(calendar.holiday_calendar(feeds.holidays, settings.custom_holidays), "holidays")
    if _gate(spark, settings, holidays) != "run":
        return None
    broken = None if feeds.broken is None else require_sound(feeds.broken, settings.most_broken)

    live = universe.active_symbols(feeds.listing)
    symbols = universe.symbols_with_fallback(live, state.symbol_cache(spark))
    symbols = landed(universe.require_symbols(symbols), "symbols")
    state.save_symbol_cache(symbols, version)

    benchmarks = units.benchmark_tickers(settings.benchmarks)
    quoted = feeds.history
    if isinstance(quoted, BucketedHistory):
        quoted = quoted.of_symbols(units.vote_candidates(symbols, benchmarks))
    own_source = quoted.filter(F.lower("source") == settings.source.lower())
    factors = units.unit_vote(symbols, feeds.board, own_source, benchmarks, settings.as_of).first()
    t0 = landed(board_bars(feeds.board, settings.source, factors["board_multiplier"]), "board")

    today = t0.agg(F.max("trading_date")).first()[0]
    if today is None:
        raise ValueError("the board has no usable row")
    last = _last_run(state.run(spark), today)
    if last["decision"].startswith("stop"):
        return None
    absent = _absent(symbols, t0, settings.most_absent)
    missing = _missing(spark, last, today, holidays)
    missing_df = unfilled = _days(spark, missing)

    listed = events.distinct_keys(t0)
    on_day = events.corporate_actions(feeds.events, today, today, listed)
    if missing:
        late = events.corporate_actions(feeds.events, missing[0], missing[-1], symbols)
    else:
        late = on_day.limit(0)
    wanted = landed(events.reload_set(on_day, late, state.pending(spark), today), "reload")

    if missing:
        filled = backfill(
            feeds.archives, missing, settings.archive_source, settings.blacklist, settings.archive_kind
        )
        filled = landed(filled, "filled")
        raw.replace_own_days(filled)
        unfilled = landed(unfilled_days(missing_df, filled), "unfilled")
    raw.replace_date(t0.select(*BAR_COLS), today)

    rebuilt = adjust.adjusted_history(
        feeds.history,
        t0.select(*BAR_COLS),
        symbols,
        wanted,
        today,
        factors["history_multiplier"],
        adjust.source_order(settings.source),
        settings.history_start,
        settings.as_of.date(),
    )
    # Written once, in the form in which both tables store it.
    rebuilt = landed(clean.encode_adjusted(rebuilt), "rebuilt")
    outcome = landed(adjust.reload_outcome(wanted, rebuilt), "outcome")
    sink_symbol_history(rebuilt, reloaded_path, settings.history_buckets, staged=True)
    adjusted.replace_symbols(rebuilt, staged=True)
    # Symbols whose reload failed are excluded too: they get no bar until it works.
    adjusted.copy_raw(raw, [*missing, today], wanted.select("symbol"))

    new = landed(snapshot.eod_snapshot(t0, state.snapshot(spark), moment, symbols), "snapshot")
    pending = events.pending_after(outcome)
    state.save(snapshot.run_metadata(t0, new, moment), pending, new, version)
    return report.run_report(t0, outcome, missing_df, moment, unfilled, absent, broken)


def _gate(spark, settings, holidays) -> str:
    """Whether to run on the day of ``as_of``: not on a weekend or holiday, unless forced."""
    return calendar.run_gate(_days(spark, [settings.as_of.date()]), holidays, settings.force).first()["gate"]


def _absent(symbols, board, most_absent: float) -> int:
    """How many listed symbols the board lacks; too many mean that it has not landed in whole."""
    found = universe.board_coverage(symbols, board)
    row = found.agg(F.count("*").alias("n"), F.count_if(~F.col("arrived")).alias("absent")).first()
    if row["absent"] > most_absent * row["n"]:
        raise ValueError(f"{row['absent']} of {row['n']} listed symbols are not on the board; nothing was changed")
    return row["absent"]


def _last_run(run: DataFrame, today: date):
    states = run.withColumn("t0_max", F.lit(today))
    row = calendar.run_decisions(states).first()
    if row is None:
        return {"decision": "run", "last_successful_run": None, "is_eod": None}
    return row.asDict()


def _missing(spark, last, today, holidays) -> list[date]:
    """Missing trading days in order; as many as the calendar since the last run."""
    states = spark.createDataFrame(
        [(today, last["last_successful_run"], last["is_eod"])],
        "t0_max date, last_successful_run string, is_eod boolean",
    )
    rows = calendar.missing_days(states, holidays).collect()
    return sorted(r["trading_date"] for r in rows)


def _days(spark, days):
    return spark.createDataFrame([(d,) for d in days], "trading_date date")
