"""Calendar, events, units, snapshot and report."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.functions.dates import moment
from barloom.operators import adjust, calendar, events, report, snapshot, symbols, units
from barloom.schema import EVENT_SCHEMA, SNAPSHOT_SCHEMA
from tests.helpers import bar, bars, d

CLOSED, OPEN = datetime(2024, 1, 30, 17, 0), datetime(2024, 1, 30, 10, 0)


def days(spark, *texts, name="trading_date"):
    return spark.createDataFrame([(d(t),) for t in texts], f"{name} date")


def test_custom_holidays_and_calendar(spark, rows):
    entries = spark.createDataFrame([(" 2026/06/15, 2026-06-16,x, ,2026-02-30",), (None,)], "entries string")
    custom = calendar.custom_holidays(entries)
    assert rows(custom) == [(d("2026-06-15"),), (d("2026-06-16"),)]
    national = days(spark, "2026-01-01", "2026-06-15", name="holiday")
    assert rows(calendar.holiday_calendar(national, custom)) == [
        (d("2026-01-01"),),
        (d("2026-06-15"),),
        (d("2026-06-16"),),
    ]


def test_run_gate_and_trading_days(spark, rows):
    week = days(spark, "2024-01-01", "2024-01-05", "2024-01-06", "2024-01-07")
    holidays = days(spark, "2024-01-01", name="holiday")
    assert [g for _, g in rows(calendar.run_gate(week, holidays))] == [
        "skip_holiday",
        "run",
        "skip_weekend",
        "skip_weekend",
    ]
    assert {g for _, g in rows(calendar.run_gate(week, holidays, force=True))} == {"run"}
    assert rows(calendar.trading_days(week, holidays)) == [(d("2024-01-05"),)]


def test_missing_days(spark, rows):
    states = spark.createDataFrame(
        [
            ("open", d("2024-01-30"), "2024-01-25", False),
            ("closed", d("2024-01-30"), "2024-01-25", True),
            ("never", d("2024-01-30"), None, True),
            ("bad", d("2024-01-30"), "n/a", True),
            ("same", d("2024-01-30"), "2024-01-30", True),
        ],
        "run string, t0_max date, last_successful_run string, is_eod boolean",
    )
    holidays = days(spark, "2024-01-29", name="holiday")
    assert rows(calendar.missing_days(states, holidays)) == [
        ("closed", d("2024-01-26")),
        ("open", d("2024-01-25")),
        ("open", d("2024-01-26")),
    ]


def event(ticker, ex, code="DIV", organ=None, record=None, ratio=None):
    return (ex, record, ticker, organ, code, ratio)


def test_corporate_actions(spark, rows):
    feed = spark.createDataFrame(
        [
            event("FPT", "2024-01-10T00:00:00", record="2024-01-11"),
            event("fpt ", "2024-01-12", code="ISS", ratio="10%"),
            event("nan", "2024-01-12", organ="hpg", code=None),
            event("VNM", "2024-01-09"),
            event("VNM", "2024-01-13"),
            event("TOO-LONG-X", "2024-01-11"),
            event("SSI", "2024-01-11", code="AGM"),
            event("VIC", None),
        ],
        EVENT_SCHEMA,
    )
    found = events.corporate_actions(feed, d("2024-01-10"), d("2024-01-12"))
    assert rows(found) == [
        ("FPT", "DIV", d("2024-01-10"), d("2024-01-11"), None),
        ("FPT", "ISS", d("2024-01-12"), None, "10%"),
        ("HPG", "DIV", d("2024-01-12"), None, None),
    ]
    assert rows(events.event_date_per_symbol(found)) == [("FPT", d("2024-01-12")), ("HPG", d("2024-01-12"))]
    only = spark.createDataFrame([("HPG",), (None,)], "symbol string")
    assert events.corporate_actions(feed, d("2024-01-10"), d("2024-01-12"), only).count() == 1


def test_reload_set_priorities(spark, rows):
    def actions(*pairs):
        return spark.createDataFrame([(s, d(x)) for s, x in pairs], "symbol string, ex_date date")

    pending = spark.createDataFrame([(" vic",), ("bad ticker",), (None,), ("HPG",)], "symbol string")
    got = events.reload_set(
        actions(("FPT", "2024-01-30"), ("SSI", "2024-01-30")),
        actions(("FPT", "2024-01-26"), ("HPG", "2024-01-27")),
        pending,
        d("2024-01-30"),
    )
    assert rows(got) == [
        ("FPT", d("2024-01-26")),
        ("HPG", d("2024-01-30")),
        ("SSI", d("2024-01-30")),
        ("VIC", d("2024-01-30")),
    ]


def test_failed_reloads_hold_back_no_other(spark, rows):
    wanted = spark.createDataFrame([(f"S{n:02d}",) for n in range(12)] + [("S00",)], "symbol string")
    adjusted = bars(spark, bar("S00", "2024-01-29"), bar("S11", "2024-01-29"), bar("S11", "2024-01-30"), bar("X", "2024-01-30"))
    outcome = adjust.reload_outcome(wanted, adjusted)
    assert rows(outcome) == [("S00", "ok"), *[(f"S{n:02d}", "failed") for n in range(1, 11)], ("S11", "ok")]
    assert rows(events.pending_after(outcome)) == [(f"S{n:02d}",) for n in range(1, 11)]


def feeds(spark, quotes, closes):
    board = spark.createDataFrame([(s, i, p) for i, (s, p) in enumerate(quotes)], "symbol string, time bigint, close_price double")
    history = spark.createDataFrame([(s, d(x), p) for s, x, p in closes], "symbol string, time date, close double")
    return board, history


def vote(spark, listed, quotes, closes, benchmarks=("FPT", "HPG", "VNM")):
    listing = spark.createDataFrame([(s, "HNX") for s in listed], "symbol string, exchange string")
    board, history = feeds(spark, quotes, closes)
    return tuple(units.unit_vote(listing, board, history, list(benchmarks), d("2024-01-30")).first())


def test_unit_vote(spark):
    listed = ["FPT", "HPG", "VNM"]
    quotes = [("FPT", 95.0), ("HPG", 28.0), ("VNM", 68000.0)]
    closes = [("FPT", "2024-01-29", 95000.0), ("FPT", "2024-01-28", 9.0), ("HPG", "2024-01-10", 2.0)]
    assert vote(spark, listed, quotes, closes) == (1000.0, 1.0)
    # A tie goes to the lower multiplier, unusable prices do not vote.
    assert vote(spark, listed, [("FPT", 95.0), ("HPG", 28000.0)], [("FPT", "2024-01-29", float("nan"))]) == (1.0, 1000.0)
    assert vote(spark, [], quotes, closes) == (1.0, 1000.0)
    # No benchmark is listed: the first symbol of three characters votes.
    assert vote(spark, ["ZZZ", "AAA", "LONG"], [("AAA", 5.0), ("ZZZ", 5000.0)], []) == (1000.0, 1000.0)


def test_symbols(spark, rows):
    listing = spark.createDataFrame(
        [("FPT", "HSX", "stock"), ("B1", "HNX", "bond"), ("F1", "HNX", "future"), ("N1", "HNX", None)],
        "symbol string, exchange string, type string",
    )
    live = symbols.active_symbols(listing)
    assert rows(live) == [("FPT", "HSX")]
    cached = spark.createDataFrame([("OLD", "HNX")], "symbol string, exchange string")
    none = live.filter("false")
    assert rows(symbols.symbols_with_fallback(live, cached)) == [("FPT", "HSX")]
    assert rows(symbols.symbols_with_fallback(none, cached)) == [("OLD", "HNX")]
    with pytest.raises(PySparkException, match="no symbols"):
        symbols.require_symbols(symbols.symbols_with_fallback(none, cached.filter("false"))).count()


def test_board_coverage(spark, rows):
    listed = spark.createDataFrame([("S0",), ("S1",), ("S1",)], "symbol string")
    board = spark.createDataFrame([("S0",), ("S0",), ("S4",), (None,)], "symbol string")
    assert rows(symbols.board_coverage(listed, board)) == [("S0", True), ("S1", False)]


def old_snapshot(spark, *rows):
    return spark.createDataFrame(list(rows), SNAPSHOT_SCHEMA)


def test_eod_snapshot(spark, rows):
    board = bars(
        spark,
        bar("A", "2024-01-30", (10.4, 12.0, 9.0, 11.0)),
        bar("A", "2024-01-29"),
        bar("B", "2024-01-30"),
        bar("C", "2024-01-30"),
        bar("", "2024-01-30"),
    )
    old = old_snapshot(
        spark,
        ("B", "HNX", d("2024-01-30"), 1, 1, 1, 1, 1.04, 1),
        ("C", "HNX", d("2024-01-31"), 2, 2, 2, 2, 2.0, 2),
        ("D", "HNX", d("2024-01-02"), 3, 3, 3, 3, 3.0, 3),
    )
    merged = snapshot.eod_snapshot(board, old, moment(CLOSED))
    assert rows(merged, "symbol", "trading_date", "close_price", "average_price") == [
        ("A", d("2024-01-30"), 11, 10.6),
        ("B", d("2024-01-30"), 10, 10.0),
        ("C", d("2024-01-31"), 2, 2.0),
        ("D", d("2024-01-02"), 3, 3.0),
    ]
    assert snapshot.run_metadata(board, merged, moment(CLOSED)).first() == ("2024-01-30", True, 4)
    # Not closed yet: stored rows stay and are only rounded again.
    kept = snapshot.eod_snapshot(board, old, moment(OPEN))
    assert rows(kept, "symbol", "average_price") == [("B", 1.0), ("C", 2.0), ("D", 3.0)]
    active = spark.createDataFrame([("A",), ("C",)], "symbol string")
    assert rows(snapshot.eod_snapshot(board, old, moment(CLOSED), active), "symbol") == [("A",), ("C",)]
    assert snapshot.eod_snapshot(board, old, moment(CLOSED), active.filter("false")).count() == 4


def test_average_price_of_the_feed_wins(spark):
    df = bars(spark, bar("A", "2024-01-30")).withColumn("average_price", F.lit(7.0))
    assert snapshot.with_average_price(df).first()["average_price"] == 7.0


def test_inherited_pending(spark, rows):
    old = spark.createDataFrame([("A",), ("A",)], "symbol string")
    given = spark.createDataFrame([("B",)], "symbol string")
    assert rows(snapshot.inherit_pending(None, old)) == [("A",)]
    assert rows(snapshot.inherit_pending(given, old)) == [("B",)]


def test_report(spark):
    board = bars(spark, bar("A", "2024-01-30"), bar("B", "2024-01-30"))
    outcome = spark.createDataFrame(
        [(f"S{n:02d}", "ok") for n in range(17)] + [("X", "failed"), ("Y", "failed")], "symbol string, status string"
    )
    line = report.run_report(board, outcome, days(spark, "2024-01-29", "2024-01-26"), moment(CLOSED)).first()
    assert line.rows_loaded == 2 and line.is_eod and line.trading_date == d("2024-01-30")
    assert line.missing_dates == "2024-01-26, 2024-01-29" and line.unfilled_dates == "Không có"
    assert line.reloaded == ", ".join(f"S{n:02d}" for n in range(15)) + " (+2 mã khác)"
    assert line.failed == "X, Y" and line.status == "⚠️"
    calm = report.run_report(board, outcome.filter("status = 'ok'"), days(spark, "2024-01-29").limit(0), moment(OPEN)).first()
    assert (calm.failed, calm.status, calm.is_eod, calm.missing_dates) == ("Không có", "✅", False, "Không có")
