"""The running day as state of a stream: the last quote per symbol, stored once the day is over.

``board_stream.refresh_table`` rewrites the day's bars with every file. Here the state store keeps
one row per symbol and open day, whatever the number of files, and a bar is written
once: when the watermark has passed the end of its market day.
"""

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import clean, contract
from barloom.operators.keyed import landed, last_by
from barloom.schema import BAR_COLS, BOARD_EXTRA_COLS, KEY, MARKET_ZONE
from barloom.sinks.bar_table import BarTable


def _midnight(zone: str) -> str:
    """Start of a day in a zone without summer time, as an offset from midnight in UTC."""
    offset = datetime(2000, 1, 1, tzinfo=ZoneInfo(zone)).utcoffset() or timedelta()
    return f"{int(-offset.total_seconds()) % 86400} seconds"


def closing_bars(stream: DataFrame, source: str, multiplier: float, delay: str = "6 hours") -> DataFrame:
    """The last bar of each symbol and market day, out of board rows in any order.

    On a stream a day's bars come once, when a quote has been seen that is ``delay`` after the day's end;
    quotes of a day that land later than that are dropped, and Spark counts them
    (``numRowsDroppedByWatermark``). On a batch the result is that of ``board_bars``. A row that breaks
    the contract stops the query.
    """
    quotes = contract.enforce_contract(clean.clean_board(stream, source))
    timed = quotes.withColumn("_moment", F.timestamp_millis("time")).withWatermark("_moment", delay)
    days = timed.withColumn("_day", F.window("_moment", "1 day", startTime=_midnight(MARKET_ZONE)))
    last = last_by(
        days, ["_day", *KEY], F.col("time"), F.col("total_volume"), keep=["_day", *quotes.columns]
    )
    bars = clean.apply_multiplier(last.drop("_day", "time"), multiplier, BOARD_EXTRA_COLS)
    return bars.select(*BAR_COLS, *BOARD_EXTRA_COLS)


def store_closed_days(
    stream: DataFrame, table: BarTable, source: str, multiplier: float, checkpoint: str, delay: str = "6 hours"
) -> StreamingQuery:
    """Take all board files landed so far, store the days that they close, and stop.

    Open days stay in the checkpoint's state, so the next call goes on with them. A batch
    that is replayed after a failure stores the same bars again.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        table.upsert(landed(batch.select(*BAR_COLS), "closed"))

    return (
        closing_bars(stream, source, multiplier, delay)
        .writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
