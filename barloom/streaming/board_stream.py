"""Refresh of the running day from board files as they land.

Until the close the same day is loaded again and again. As a stream, every batch
of new board files updates the bars of its symbols and days in the raw table.
"""

from pyspark.sql import DataFrame, SparkSession

from barloom.plans.daily import board_bars
from barloom.schema import BAR_COLS, BOARD_SCHEMA
from barloom.sinks.bar_table import BarTable


def board_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BOARD_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def refresh_table(
    stream: DataFrame, table: BarTable, source: str, multiplier: float, checkpoint: str
):
    """Apply all files landed so far, then stop. Returns the streaming query.

    A board file may hold some symbols only, so its bars are upserted rather than
    put in place of the whole day. Volume accumulates over a day, so of two bars the one with
    the greater volume is the later one; files may land in any order, and a batch that
    is replayed after a failure changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        bars = board_bars(batch, source, multiplier).select(*BAR_COLS)
        table.upsert(bars, greatest="total_volume")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
