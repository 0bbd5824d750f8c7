"""New content of a table after a load: target and incoming frames to a new target.

Each function is idempotent, so a repeated or restarted load changes nothing. The
sinks decide which partitions of the stored table have to be read and written.
"""

from pyspark.sql import Column, DataFrame, functions as F

from barloom.operators.keyed import drop_keys, last_by
from barloom.schema import KEY, PRICE_ADJ, PRICE_COLS


def replace_dates(target: DataFrame, incoming: DataFrame, days: list) -> DataFrame:
    """Replace some days of the target by the incoming rows of these days.

    Incoming rows of other days, such as a board's bars of symbols that have not traded since,
    take the place of the target's rows with their key.
    """
    listed = F.col("trading_date").isin([F.lit(d).cast("date") for d in days])
    on_days = F.coalesce(listed, F.lit(False))
    kept = target.filter(~on_days)
    kept = drop_keys(kept, incoming.filter(~on_days).select(*KEY).distinct(), KEY)
    return kept.unionByName(incoming.select(*target.columns))


def replace_date(target: DataFrame, incoming: DataFrame, day) -> DataFrame:
    return replace_dates(target, incoming, [day])


def replace_symbols(
    target: DataFrame, incoming: DataFrame, as_of=None, per_symbol: bool = False
) -> DataFrame:
    """Replace the symbols of ``incoming`` from its first date on; older rows stay.

    The first date is that of the whole batch, or of each symbol on request. An
    empty batch replaces nothing, ``as_of`` only stands in for its first date.
    """
    if per_symbol:
        starts = incoming.groupBy("symbol").agg(F.min("trading_date").alias("_start"))
        replaced = (F.col("t.symbol") == F.col("s.symbol")) & (F.col("trading_date") >= F.col("_start"))
        kept = target.alias("t").join(starts.alias("s"), replaced, "left_anti")
        return kept.unionByName(incoming.select(*target.columns))
    start = batch_start(incoming, as_of)
    older = target.filter(F.col("trading_date") < start)
    newer = target.filter(F.col("trading_date") >= start)
    kept = drop_keys(newer, incoming.select("symbol").distinct(), "symbol")
    return older.unionByName(kept).unionByName(incoming.select(*target.columns))


def batch_start(incoming: DataFrame, as_of=None) -> Column:
    """First date of a batch as a scalar subquery, ``as_of`` when it is empty."""
    fallback = F.lit(as_of).cast("date") if as_of is not None else F.lit("9999-12-31").cast("date")
    return incoming.agg(F.coalesce(F.min("trading_date"), fallback).alias("start")).scalar()


def copy_raw_to_adjusted(
    raw: DataFrame, adjusted: DataFrame, days: list, excluded: DataFrame
) -> DataFrame:
    """Replace the days in the adjusted table by raw bars, except for some symbols.

    ``days`` is the run's short list of dates; as literals they reach the scan.
    Rows of other days pass through without any join.
    """
    if not days:
        return adjusted
    on_days = F.col("trading_date").isin([F.lit(d).cast("date") for d in days])
    keys = excluded.select("symbol").dropna().distinct()
    untouched = adjusted.filter(~on_days)
    protected = adjusted.filter(on_days).join(keys, "symbol", "left_semi")
    copied = raw.filter(on_days).join(keys, "symbol", "left_anti")
    copied = copied.withColumns({c: F.col(c).cast(PRICE_ADJ) for c in PRICE_COLS})
    out = adjusted.columns
    return untouched.unionByName(protected.select(*out)).unionByName(copied.select(*out))


def upsert(
    target: DataFrame, incoming: DataFrame, keys: list[str] = KEY, order=(), greatest: str | None = None
) -> DataFrame:
    """Insert or update by key; nothing is deleted. ``order`` decides repeated keys.

    With ``greatest`` the row that has most of that column stays, the incoming one if equal, so
    that batches may come in any order.
    """
    fresh = last_by(incoming, keys, *order, keep=target.columns)
    if greatest is None:
        return drop_keys(target, fresh.select(*keys), keys).unionByName(fresh)
    both = target.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    return last_by(both, keys, F.col(greatest), F.col("_new"), keep=target.columns)


def load_append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return target.unionByName(incoming.select(*target.columns))


def load_truncate(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.select(*target.columns)


def state_put(state: DataFrame, entries: DataFrame) -> DataFrame:
    return upsert(state, entries, ["key"])


def state_get(state: DataFrame, key: str) -> DataFrame:
    """The value stored under the key; no row when there is none."""
    return state.filter(F.col("key") == key).select("value")


def max_trading_date(df: DataFrame) -> DataFrame:
    return df.agg(F.max("trading_date").alias("trading_date"))


