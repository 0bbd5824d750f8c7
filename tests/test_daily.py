"""Whole daily runs on a small market, and the stream over board files."""

import io
import zipfile
from datetime import datetime

import pytest

from barloom.plans.daily import DailyFeeds, DailySettings, run_daily
from barloom.schema import BOARD_SCHEMA, EVENT_SCHEMA, HISTORY_FEED_SCHEMA, KEY
from barloom.sinks.bar_table import BarTable, read_symbol_history
from barloom.sinks.run_state import RunState
from barloom.streaming.board_stream import board_stream, refresh_table
from tests.helpers import d

NOON = 1706590800000  # 2024-01-30 12:00 in the market


class Market:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.raw = BarTable(str(tmp_path / "raw"), buckets=2)
        self.adjusted = BarTable(str(tmp_path / "adj"), adjusted=True, buckets=2)
        self.state = RunState(str(tmp_path / "state"))
        self.reloaded = str(tmp_path / "reloaded")
        self.listing = [("FPT", "HSX", "stock"), ("HPG", "hose", "stock"), ("VNM", "HNX", "stock")]
        self.events = []

    def board(self, day_offset, price):
        at = NOON + day_offset * 86_400_000
        return [(s, e, at, price, price, price, price, price, price, 100) for s, e, _ in self.listing_all]

    @property
    def listing_all(self):
        return self.listing or [("FPT", "HSX", "stock"), ("HPG", "hose", "stock"), ("VNM", "HNX", "stock")]

    def run(self, as_of, board, history=(), **settings):
        spark = self.spark
        feeds = DailyFeeds(
            listing=spark.createDataFrame(self.listing, "symbol string, exchange string, type string"),
            board=spark.createDataFrame(board, BOARD_SCHEMA),
            history=spark.createDataFrame([(s, "VCI", d(x), p, p, p, p, 1) for s, x, p in history], HISTORY_FEED_SCHEMA),
            events=spark.createDataFrame(self.events, EVENT_SCHEMA),
            holidays=spark.createDataFrame([(d("2024-01-01"),)], "holiday date"),
            archives=spark.createDataFrame([("x/Raw.Upto31012024.zip", _zip("FPT,20240131,99,99,99,99,5\n"))], "path string, content binary"),
        )
        settings = DailySettings(datetime.fromisoformat(as_of), **settings)
        return run_daily(spark, feeds, self.raw, self.adjusted, self.state, self.reloaded, settings)

    def prices(self, rows, table):
        return [(s, str(day), float(p)) for s, day, p in rows(table.read(self.spark), *KEY, "close_price")]


def _zip(text):
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as z:
        z.writestr("HSX.csv", text)
    return content.getvalue()


def test_daily_runs(spark, rows, tmp_path):
    market = Market(spark, tmp_path)
    # First run, during the session; the board quotes thousands.
    report = market.run("2024-01-30T14:00:00", market.board(0, 95.0)).first()
    assert (report.rows_loaded, report.is_eod, report.missing_dates, report.status) == (3, False, "Không có", "✅")
    first = [(s, "2024-01-30", 95000.0) for s in ("FPT", "HPG", "VNM")]
    assert market.prices(rows, market.raw) == market.prices(rows, market.adjusted) == first
    assert market.state.snapshot(spark).count() == 0

    # The day is not closed, so a later run replaces it; then it is done.
    market.run("2024-01-30T17:00:00", market.board(0, 96.0))
    assert {p for _, _, p in market.prices(rows, market.raw)} == {96000.0}
    assert market.state.snapshot(spark).count() == 3
    assert market.run("2024-01-30T18:00:00", market.board(0, 97.0)) is None
    assert market.run("2024-01-30T18:00:00", market.board(-1, 97.0)) is None

    # Two days later: the 31st is back-filled, FPT and HPG have events, HPG has no history.
    market.listing = []  # the live list fails, the cached one is used
    market.events = [
        ("2024-02-01", None, "FPT", None, "DIV", None),
        ("2024-01-31T00:00:00", None, None, "hpg", "ISS", "10%"),
        ("2024-02-02", None, "VNM", None, "DIV", None),
    ]
    history = [("FPT", "2024-01-29", 40.0), ("FPT", "2024-01-30", 48.0), ("FPT", "2024-01-31", 49.0)]
    report = market.run("2024-02-01T17:00:00", market.board(2, 50.0), history).first()
    assert (report.missing_dates, report.unfilled_dates) == ("2024-01-31", "Không có")
    assert (report.reloaded, report.failed, report.status) == ("FPT", "HPG", "⚠️")
    assert market.prices(rows, market.raw) == [
        ("FPT", "2024-01-30", 96000.0),
        ("FPT", "2024-01-31", 99000.0),
        ("FPT", "2024-02-01", 50000.0),
        ("HPG", "2024-01-30", 96000.0),
        ("HPG", "2024-02-01", 50000.0),
        ("VNM", "2024-01-30", 96000.0),
        ("VNM", "2024-02-01", 50000.0),
    ]
    # FPT is rebuilt and filled up to today; HPG waits without a bar of today.
    assert market.prices(rows, market.adjusted) == [
        ("FPT", "2024-01-29", 40000.0),
        ("FPT", "2024-01-30", 48000.0),
        ("FPT", "2024-01-31", 49000.0),
        ("FPT", "2024-02-01", 50000.0),
        ("HPG", "2024-01-30", 96000.0),
        ("VNM", "2024-01-30", 96000.0),
        ("VNM", "2024-02-01", 50000.0),
    ]
    assert rows(market.state.pending(spark)) == [("HPG",)]
    assert rows(read_symbol_history(spark, market.reloaded).select("symbol").distinct()) == [("FPT",)]

    # The next day HPG is tried again because it is pending.
    market.events = []
    report = market.run("2024-02-02T17:00:00", market.board(3, 51.0), [("HPG", "2024-02-02", 44.0)]).first()
    assert (report.reloaded, report.failed, report.status) == ("HPG", "Không có", "✅")
    assert rows(market.state.pending(spark)) == []
    assert ("HPG", "2024-02-02", 44000.0) in market.prices(rows, market.adjusted)


def test_closed_days_and_boards_that_lack_symbols(spark, rows, tmp_path):
    market = Market(spark, tmp_path)
    custom = spark.createDataFrame([(d("2024-01-30"),)], "holiday date")
    assert market.run("2024-01-28T12:00:00", market.board(0, 95.0)) is None  # a Sunday
    assert market.run("2024-01-30T14:00:00", market.board(0, 95.0), custom_holidays=custom) is None
    with pytest.raises(ValueError, match="2 of 3 listed symbols are not on the board"):
        market.run("2024-01-30T14:00:00", market.board(0, 95.0)[:1])
    assert market.raw.read(spark).count() == market.state.run(spark).count() == 0
    report = market.run("2024-01-30T14:00:00", market.board(0, 95.0)[:2], custom_holidays=custom, force=True).first()
    assert (report.rows_loaded, report.absent_symbols) == (2, 1)


def test_failed_reloads_and_old_board_days(spark, rows, tmp_path):
    """Five symbols without history come before a good one; STALE last traded the day before."""
    market = Market(spark, tmp_path)
    names = ["AA1", "AA2", "AA3", "AA4", "AA5", "FPT", "STALE"]
    market.listing = [(n, "HSX", "stock") for n in names]
    market.events = [("2024-01-30", None, n, None, "DIV", None) for n in names[:6]]
    board = [row if row[0] != "STALE" else (*row[:2], NOON - 86_400_000, *row[3:]) for row in market.board(0, 50.0)]
    for hour in (13, 14, 15):
        report = market.run(f"2024-01-30T{hour}:00:00", board, [("FPT", "2024-01-29", 48.0)]).first()
        assert (report.reloaded, report.failed) == ("FPT", "AA1, AA2, AA3, AA4, AA5")
        raw = market.prices(rows, market.raw)
        assert raw == [*[(n, "2024-01-30", 50000.0) for n in names[:6]], ("STALE", "2024-01-29", 50000.0)]
    assert ("FPT", "2024-01-29", 48000.0) in market.prices(rows, market.adjusted)
    assert rows(market.state.pending(spark)) == [(n,) for n in names[:5]]


def test_a_board_that_breaks_the_contract_stops_the_run(spark, tmp_path):
    market = Market(spark, tmp_path)
    board = market.board(0, 95.0) + [("x y", "HSX", NOON, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    with pytest.raises(Exception, match="data contract broken by X Y"):
        market.run("2024-01-30T14:00:00", board)
    assert market.raw.read(spark).count() == 0


def test_board_stream(spark, rows, tmp_path):
    landed, table = tmp_path / "board", BarTable(str(tmp_path / "raw"), buckets=2)
    landed.mkdir()

    def land(name, *quotes):
        lines = [
            f'{{"symbol":"{s}","exchange":"HSX","time":{NOON + t},"open_price":{p},"high_price":{p},"low_price":{p},"close_price":{p},"volume_accumulated":{t}}}'
            for s, t, p in quotes
        ]
        (landed / name).write_text("\n".join(lines))

    def refresh():
        stream = board_stream(spark, str(landed), files_per_batch=1)
        refresh_table(stream, table, "vci", 1000.0, str(tmp_path / "offsets")).awaitTermination()
        return rows(table.read(spark), "symbol", "close_price", "total_volume")

    land("1.json", ("FPT", 1, 95.0), ("FPT", 2, 96.0), ("HPG", 1, 28.0))
    assert refresh() == [("FPT", 96000, 2), ("HPG", 28000, 1)]
    land("2.json", ("FPT", 3, 97.0), ("VNM", 3, 68.0))
    assert refresh() == [("FPT", 97000, 3), ("HPG", 28000, 1), ("VNM", 68000, 3)]
    assert len(refresh()) == 3
    # A file of an earlier moment that lands late changes nothing.
    land("3.json", ("FPT", 2, 90.0), ("HPG", 4, 29.0))
    assert refresh() == [("FPT", 97000, 3), ("HPG", 29000, 4), ("VNM", 68000, 3)]
