"""Readers for landed feeds. Every one declares its schema.

A line of a JSON feed that is no JSON gives no row. ``broken_lines`` counts such lines by file, and
``require_sound`` stops a run if there are too many. A line of which only some fields don't
fit stays, with these fields null.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from barloom.functions import text
from barloom.schema import (
    BOARD_SCHEMA,
    EVENT_PAGE_SCHEMA,
    HISTORY_FEED_SCHEMA,
    HISTORY_LINE_SCHEMA,
    LISTING_SCHEMA,
    MOST_BROKEN_SHARE,
)

#: JSON feeds and their schemas.
JSON_FEEDS = {"board": BOARD_SCHEMA, "events": EVENT_PAGE_SCHEMA, "listing": LISTING_SCHEMA}
_BROKEN = "_broken_line"


def _json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of JSON lines, with the text of lines that don't fit in ``_BROKEN``."""
    wide = StructType([*schema.fields]).add(_BROKEN, StringType())
    return spark.read.schema(wide).option("columnNameOfCorruptRecord", _BROKEN).json(path)


def _lost(schema: StructType) -> Column:
    """Whether a line told nothing: it doesn't fit, and no field could be read."""
    nothing = reduce(lambda a, b: a & b, [F.col(f.name).isNull() for f in schema.fields])
    return F.col(_BROKEN).isNotNull() & nothing


def _sound(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _json(spark, path, schema).filter(~_lost(schema)).drop(_BROKEN)


def broken_lines(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """(feed, file, lines, broken) for each file of a JSON feed; blank lines don't count."""
    schema = JSON_FEEDS[feed]
    rows = _json(spark, path, schema).select(F.col("_metadata.file_path").alias("file"), _lost(schema).alias("lost"))
    counts = rows.groupBy("file").agg(F.count("*").alias("lines"), F.count_if("lost").alias("broken"))
    return counts.select(F.lit(feed).alias("feed"), "file", "lines", "broken")


def require_sound(counts: DataFrame, most_broken: float = MOST_BROKEN_SHARE) -> int:
    """The number of broken lines; an error if some feed's share of them is above ``most_broken``."""
    rows = counts.groupBy("feed").agg(
        F.sum("lines").alias("lines"),
        F.sum("broken").alias("broken"),
        F.max_by("file", "broken").alias("worst"),
    )
    found = rows.collect()  # a row per feed
    for row in found:
        if row.broken > most_broken * row.lines:
            raise ValueError(
                f"{row.broken} of {row.lines} lines of the feed {row.feed!r} are broken, most in {row.worst}; nothing was changed"
            )
    return sum(row.broken for row in found)


def csv_scan(spark: SparkSession, path: str) -> DataFrame:
    """Unzipped history CSVs; the file name tells the exchange."""
    rows = spark.read.schema(HISTORY_LINE_SCHEMA).option("mode", "PERMISSIVE").csv(path)
    name = F.col("_metadata.file_name")
    return rows.select("*", text.normalize_exchange(name).alias("exchange"))


def board_scan(spark: SparkSession, path: str) -> DataFrame:
    """Board snapshots landed as JSON, one folder or file per request batch."""
    return _sound(spark, path, BOARD_SCHEMA)


def board_union(*batches: DataFrame) -> DataFrame:
    """Board batches read apart, brought to the board's types and columns."""
    first, *rest = [
        b.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BOARD_SCHEMA])
        for b in batches
    ]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def history_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_FEED_SCHEMA).parquet(path)


def event_scan(spark: SparkSession, path: str) -> DataFrame:
    """Pages of corporate events as JSON; fields may be missing anywhere."""
    pages = _sound(spark, path, EVENT_PAGE_SCHEMA)
    return pages.select(F.inline("data.content"))


def listing_scan(spark: SparkSession, path: str) -> DataFrame:
    return _sound(spark, path, LISTING_SCHEMA)


def blacklist_load(spark: SparkSession, path: str) -> DataFrame:
    return blacklist_symbols(spark.read.text(path))


def blacklist_symbols(lines: DataFrame, column: str = "value") -> DataFrame:
    """One symbol per line; blank lines and ``#`` comments are skipped."""
    symbol = text.normalize_symbol(F.col(column))
    symbols = lines.select(symbol.alias("symbol"))
    kept = (F.col("symbol") != "") & ~F.col("symbol").startswith("#")
    return symbols.filter(kept).distinct()
