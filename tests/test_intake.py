"""Archives taken by a stream, and feeds with broken lines."""

from datetime import datetime

import pytest

from barloom.plans import daily
from barloom.sinks.bar_table import BarTable
from barloom.sources import feeds
from barloom.streaming.archive_intake import archive_stream, take_archives
from tests.helpers import d
from tests.test_archives import GOOD, broken_entry, packed


def land(folder, day, content, raw=True):
    (folder / f"{'Raw.' if raw else ''}Upto{day}.zip").write_bytes(content)


def one_bar(day, volume):
    line = f"AAA,{day},1,2,1,1,{volume}\n"
    return packed([("x.HNX.csv", line + "AAA,20240101,1,2,1,1,5\n")])


def test_archives_are_taken_once(spark, rows, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    table = BarTable(str(tmp_path / "raw"), buckets=1)

    def take(**options):
        query = take_archives(archive_stream(spark, str(folder), **options), table, "archive", str(tmp_path / "ledger"))
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    land(folder, "05012024", one_bar("20240105", 50))
    land(folder, "05012024", one_bar("20240105", 99), raw=False)
    land(folder, "04012024", b"<html>not found</html>")
    land(folder, "03012024", broken_entry())
    assert take() == 4
    assert rows(table.read(spark), "symbol", "trading_date", "total_volume") == [("AAA", d("2024-01-05"), 50)]
    written = sorted(p for p in (tmp_path / "raw").rglob("*.parquet"))
    assert take() == 0 and sorted(p for p in (tmp_path / "raw").rglob("*.parquet")) == written

    land(folder, "02012024", GOOD)  # a late day; the day it also holds beside its own is left alone
    land(folder, "08012024", one_bar("20240108", 80))
    assert take(files_per_batch=1) == 2 and take() == 0
    got = rows(table.read(spark), "symbol", "trading_date", "total_volume")
    assert got == [
        ("AAA", d("2024-01-05"), 50),
        ("AAA", d("2024-01-08"), 80),
        ("FPT", d("2024-01-02"), 300),
        ("SHS", d("2024-01-02"), 7),
    ]


BOARD = '{"symbol":"A","close_price":1,"time":5}\n'


def test_broken_lines_are_counted_and_give_no_row(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text(BOARD + '{"symbol":"B","close_\n\n<html>\n' + '{"symbol":"C","close_price":"x"}\n{}\n')
    (tmp_path / "b.json").write_text(BOARD * 3)
    path = str(tmp_path)
    got = rows(feeds.board_scan(spark, path), "symbol", "close_price")
    assert got == [(None, None), ("A", 1.0), ("A", 1.0), ("A", 1.0), ("A", 1.0), ("C", None)]
    counts = feeds.broken_lines(spark, path, "board")
    assert [(f[-6:], n, b) for _, f, n, b in rows(counts)] == [("a.json", 5, 2), ("b.json", 3, 0)]
    assert feeds.require_sound(counts, 0.25) == 2
    with pytest.raises(ValueError, match="2 of 8 lines of the feed 'board' are broken, most in .*a.json"):
        feeds.require_sound(counts)


def test_broken_pages_and_lists(spark, rows, tmp_path):
    (tmp_path / "e.json").write_text('{"data":{"content":[{"ticker":"FPT"}]}}\n{"data":{"content":[{"tick\n{"data":{}}\n')
    assert rows(feeds.event_scan(spark, str(tmp_path)), "ticker") == [("FPT",)]
    assert rows(feeds.broken_lines(spark, str(tmp_path), "events"), "lines", "broken") == [(3, 1)]
    assert rows(feeds.listing_scan(spark, str(tmp_path))) == [(None, None, None)] * 2
    assert feeds.require_sound(feeds.broken_lines(spark, str(tmp_path), "events").limit(0)) == 0


def test_a_run_stops_before_it_writes(spark, tmp_path):
    (tmp_path / "b.json").write_text(BOARD + "<html>\n")
    counts = feeds.broken_lines(spark, str(tmp_path), "board")
    settings = daily.DailySettings(as_of=datetime(2024, 1, 30, 17, 0), force=True)
    empty = spark.createDataFrame([], "holiday date")
    run = daily.DailyFeeds(None, None, None, None, empty, None, broken=counts)
    with pytest.raises(ValueError, match="are broken"):
        daily.run_daily(spark, run, None, None, None, str(tmp_path / "out"), settings)
    assert not (tmp_path / "out").exists()
