"""The running day as a stream: order, replay, lateness and the close."""

import json

from barloom.schema import BAR_COLS, BOARD_SCHEMA
from barloom.sinks.bar_table import BarTable
from barloom.plans.daily import board_bars
from barloom.streaming.board_stream import board_stream
from barloom.streaming.running_day import closing_bars, store_closed_days
from tests.helpers import d

HOUR = 3_600_000
#: 2024-01-30 00:00 at the market (UTC+7).
MIDNIGHT = 1_706_547_600_000
COLUMNS = ("symbol", "trading_date", "close_price", "total_volume")


def quote(symbol, hour, volume, price):
    fields = {f"{p}_price": price for p in ("open", "high", "low", "close")}
    return {"symbol": symbol, "exchange": "HSX", "time": MIDNIGHT + int(hour * HOUR), "volume_accumulated": volume, **fields}


def test_days_are_stored_once_they_are_over(spark, rows, tmp_path):
    folder, table = tmp_path / "board", BarTable(str(tmp_path / "raw"), buckets=2)
    folder.mkdir()

    def land(name, *quotes):
        (folder / name).write_text("\n".join(json.dumps(q) for q in quotes))

    def run():
        stream = board_stream(spark, str(folder), files_per_batch=1)
        query = store_closed_days(stream, table, "vci", 1000.0, str(tmp_path / "state"), "2 hours")
        query.awaitTermination()
        dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
        return rows(table.read(spark), *COLUMNS), sum(dropped)

    # The later file of the day lands first; the first and last hour of the market's day are its own.
    land("1.json", quote("FPT", 14, 30, 97.0), quote("HPG", 0, 1, 28.0), quote("FPT", 14, 30, 96.0))
    land("2.json", quote("FPT", 9, 10, 95.0), quote("HPG", 23.99, 9, 29.0), quote("VNM", 10, 5, 68.0))
    assert run() == ([], 0)
    # The next day begins, less than two hours in: the day before stays open, also for a late file.
    land("3.json", quote("FPT", 25, 1, 98.0))
    land("4.json", quote("VNM", 11, 6, 69.0))
    assert run() == ([], 0)
    land("5.json", quote("HPG", 33, 2, 30.0))
    closed = [
        ("FPT", d("2024-01-30"), 97000, 30),
        ("HPG", d("2024-01-30"), 29000, 9),
        ("VNM", d("2024-01-30"), 69000, 6),
    ]
    assert run() == (closed, 0)
    assert run() == (closed, 0)
    # Quotes of a closed day are dropped and counted; those of the open day are still taken.
    land("6.json", quote("FPT", 15, 99, 1.0), quote("FPT", 34, 7, 99.0))
    assert run() == (closed, 1)
    land("7.json", quote("FPT", 75, 1, 90.0))
    found, _ = run()
    assert found == sorted([*closed, ("FPT", d("2024-01-31"), 99000, 7), ("HPG", d("2024-01-31"), 30000, 2)])

    # What was stored is what the batch makes of the same quotes, but for the dropped one and the open day.
    board = spark.read.schema(BOARD_SCHEMA).json([str(folder / f"{n}.json") for n in (1, 2, 3, 4, 5)])
    extra = spark.createDataFrame([tuple(quote("FPT", 34, 7, 99.0).get(c) for c in BOARD_SCHEMA.names)], BOARD_SCHEMA)
    board = board.unionByName(extra)
    batch = closing_bars(board, "vci", 1000.0).select(*BAR_COLS)
    assert rows(batch) == rows(board_bars(board, "vci", 1000.0).select(*BAR_COLS))
    assert rows(batch, *COLUMNS) == [(s, day, float(p), v) for s, day, p, v in found]
