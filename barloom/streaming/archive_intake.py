"""Intake of daily archives as they land: a file stream whose checkpoint is the ledger.

A run takes the archives that no run took before, whatever their day, fills each day
from its own archive, and stops. Files that were taken are not opened again.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import clean
from barloom.operators.keyed import landed
from barloom.schema import BAR_COLS
from barloom.sinks.bar_table import BarTable
from barloom.sources.archives import archive_day, archive_order, archive_scan, select_archives

_FILE = "path string, modificationTime timestamp, length long, content binary"
# Spark forgets files that are this much older than the newest one; a late archive may be old.
_MAX_AGE = "36500d"


def archive_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """(path, content) of the archives in ``folder``, each once."""
    reader = spark.readStream.format("binaryFile").schema(_FILE)
    reader = reader.option("pathGlobFilter", "*.zip").option("maxFileAge", _MAX_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", "content")


def own_day_bars(files: DataFrame, source: str, blacklist: DataFrame | None = None, kind: str = "raw") -> DataFrame:
    """Of each archive of a kind the clean bars of the day it is named after; other days are left to theirs."""
    bars = clean.clean_history(archive_scan(select_archives(files, kind)), source, blacklist)
    own = bars.filter(F.col("trading_date") == archive_day(F.col("archive")))
    return clean.dedup_bars(own, *archive_order(), keep=BAR_COLS)


def take_archives(
    stream: DataFrame,
    table: BarTable,
    source: str,
    checkpoint: str,
    blacklist: DataFrame | None = None,
    kind: str = "raw",
) -> StreamingQuery:
    """Fill the days of all archives landed and not yet taken. Returns the streaming query.

    A day is replaced as a whole, so a batch that is replayed after a failure changes
    nothing. Archives of the other kind, damaged ones, and files that are no archive fill no day; they count as
    taken and are told by ``archive_problems`` and ``quarantined``.
    """

    def fill(batch: DataFrame, batch_id: int) -> None:
        table.replace_own_days(landed(own_day_bars(batch, source, blacklist, kind), "intake"))

    return (
        stream.writeStream.foreachBatch(fill)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
