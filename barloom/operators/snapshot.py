"""End-of-day snapshot per symbol and the metadata of a run."""

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions import dates, prices
from barloom.operators.keyed import keep_keys, last_by
from barloom.schema import PRICE_COLS, SNAPSHOT_COLS


def latest_per_symbol(bars: DataFrame, *order: Column) -> DataFrame:
    return last_by(bars, ["symbol"], F.col("trading_date"), *order)


def with_average_price(bars: DataFrame) -> DataFrame:
    """Mean of the four prices, unless the bars bring an average of their own."""
    if "average_price" in bars.columns:
        return bars
    return bars.withColumn("average_price", prices.average_of_prices())


def round_snapshot(df: DataFrame) -> DataFrame:
    rounded = {c: prices.raw_price(F.col(c).cast("double")) for c in PRICE_COLS}
    rounded["average_price"] = F.round(F.col("average_price").cast("double"), 1)
    return df.withColumns(rounded).select(*SNAPSHOT_COLS)


def eod_snapshot(
    bars: DataFrame, old: DataFrame, as_of: Column, active: DataFrame | None = None
) -> DataFrame:
    """Snapshot after a run at ``as_of``.

    Only a closed day changes it, and only where the new row is not older than
    the stored one. With active symbols given, the others are removed; an empty
    set of them means no restriction.
    """
    new = round_snapshot(with_average_price(latest_per_symbol(bars)))
    closed = _last_day(bars).select(dates.is_eod(F.col("day"), as_of).alias("closed")).scalar()
    new = new.filter(closed & (F.col("symbol") != ""))
    both = round_snapshot(old).withColumn("_new", F.lit(0))
    both = both.unionByName(new.withColumn("_new", F.lit(1)))
    merged = last_by(both, ["symbol"], F.col("trading_date"), F.col("_new"), keep=SNAPSHOT_COLS)
    if active is None or active.isEmpty():
        return merged
    return keep_keys(merged, active.select("symbol").distinct(), "symbol")


def run_metadata(bars: DataFrame, snapshot: DataFrame, as_of: Column) -> DataFrame:
    """One row: last day loaded, whether it was closed, and the snapshot's size."""
    total = snapshot.agg(F.count("*").alias("n")).scalar()
    return _last_day(bars).select(
        F.date_format("day", "yyyy-MM-dd").alias("last_successful_run"),
        dates.is_eod(F.col("day"), as_of).alias("is_eod"),
        total.alias("total_tickers"),
    )


def inherit_pending(given: DataFrame | None, old: DataFrame) -> DataFrame:
    """Symbols waiting for a reload: those given, or the stored ones if none were."""
    return (old if given is None else given).select("symbol").distinct()


def _last_day(bars):
    return bars.agg(F.max("trading_date").alias("day"))
