"""The universe of listed symbols."""

from pyspark.sql import DataFrame, functions as F

from barloom.schema import EXCLUDED_TYPES


def active_symbols(listing: DataFrame) -> DataFrame:
    """Listed symbols without bonds and futures; a null type is left out as well."""
    return listing.filter(~F.col("type").isin(EXCLUDED_TYPES)).select("symbol", "exchange")


def symbols_with_fallback(live: DataFrame, cached: DataFrame) -> DataFrame:
    """The live list, or the cached one when the live list has no row at all."""
    is_live = live.limit(1).agg((F.count("*") > 0).alias("is_live")).scalar()
    return live.unionByName(cached.filter(~is_live))


def require_symbols(symbols: DataFrame) -> DataFrame:
    """The same list, but the job that reads it fails when it is empty."""
    failure = F.raise_error(F.lit("no symbols: live list and cache are both empty"))
    found = symbols.limit(1).agg(F.count("*").alias("n"))
    # Never adds a row: it is either filtered out or fails while being filtered.
    guard = found.filter(F.when(F.col("n") > 0, F.lit(False)).otherwise(failure.cast("boolean")))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in symbols.schema]
    return symbols.unionByName(guard.select(*nothing))


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.filter(F.col("symbol") != "").select("symbol").distinct()


def board_coverage(symbols: DataFrame, board: DataFrame) -> DataFrame:
    """Every listed symbol and whether the board has a row of it."""
    arrived = board.select("symbol").distinct().withColumn("arrived", F.lit(True))
    listed = symbols.select("symbol").distinct().join(arrived, "symbol", "left")
    return listed.select("symbol", F.coalesce("arrived", F.lit(False)).alias("arrived"))
