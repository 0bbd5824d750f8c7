"""Cleaning of history lines, board rows and downloaded history."""

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions import dates, prices, text
from barloom.operators.columns import compute_once
from barloom.operators.keyed import drop_keys, last_by
from barloom.schema import (
    BAR_COLS,
    BOARD_EXTRA_COLS,
    KEY,
    PRICE_COLS,
    PRICE_FACTOR,
)


def sanitize_prices(df: DataFrame) -> DataFrame:
    """Rows whose four prices are all present and finite."""
    return df.filter(prices.has_finite_prices())


def valid_bars(df: DataFrame) -> DataFrame:
    return df.filter(~prices.invalid_bar())


def drop_blacklisted(df: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    if blacklist is None:
        return df
    return drop_keys(df, blacklist.select("symbol").distinct(), "symbol")


def scale_prices(df: DataFrame, factor=PRICE_FACTOR) -> DataFrame:
    return df.withColumns({c: prices.scale_price(F.col(c), factor) for c in PRICE_COLS})


def apply_multiplier(df: DataFrame, multiplier: float | Column, extra=()) -> DataFrame:
    """Multiply prices by a number or a scalar subquery. Columns not there are left out."""
    scaled = [c for c in [*PRICE_COLS, *extra] if c in df.columns]
    by = multiplier if isinstance(multiplier, Column) else F.lit(multiplier)
    return df.withColumns({c: F.col(c) * by for c in scaled})


def clean_history(lines: DataFrame, source: str, blacklist: DataFrame | None = None) -> DataFrame:
    """History lines (text date and volume, prices in thousands) to clean bars.

    Columns beyond the bar's own, such as the position of a line, are kept.
    """
    extra = [c for c in lines.columns if c not in BAR_COLS]
    # Row filters on columns as they came run first, the anti join sees the least.
    present = sanitize_prices(lines).dropna(subset=["symbol", "trading_date", "total_volume"])
    typed = compute_once(
        present,
        {
            "symbol": text.normalize_symbol(F.col("symbol")),
            "trading_date": dates.parse_trading_date(F.col("trading_date")),
            "total_volume": prices.to_volume(F.col("total_volume")),
            **{c: prices.scale_price(F.col(c)) for c in PRICE_COLS},
        },
    ).withColumn("source", F.lit(source))
    valid = valid_bars(typed.dropna(subset=["trading_date"]))
    return drop_blacklisted(valid, blacklist).select(*BAR_COLS, *extra)


def dedup_bars(df: DataFrame, *order: Column, keep: list[str] | None = None) -> DataFrame:
    """One bar per (symbol, trading_date): the last under ``order``."""
    return last_by(df, KEY, *order, keep=keep)


def clean_board(board: DataFrame, source: str) -> DataFrame:
    """Board rows to clean bars; reference and average price and the time stay on."""
    present = sanitize_prices(board).dropna(subset=["time", "volume_accumulated"])
    typed = compute_once(
        present.withColumnRenamed("volume_accumulated", "total_volume"),
        {
            "symbol": text.normalize_symbol(F.col("symbol")),
            "trading_date": dates.epoch_ms_to_market_date(F.col("time")),
            "exchange": text.normalize_exchange(F.col("exchange")),
        },
    ).withColumn("source", F.lit(source.lower()))
    return valid_bars(typed).select(*BAR_COLS, *BOARD_EXTRA_COLS, "time")


def reattach_reference(bars: DataFrame, board: DataFrame, *order: Column) -> DataFrame:
    """Left join of reference and average price, one board row per key at most.

    Without the de-duplication a repeated key on the board would multiply bars.
    """
    extras = last_by(board, KEY, *order, keep=[*KEY, *BOARD_EXTRA_COLS])
    return bars.join(extras, KEY, "left")


def clean_download(history: DataFrame, multiplier: float | Column) -> DataFrame:
    """Downloaded history (time, open, ... volume) to clean bars without exchange."""
    renamed = history.select(
        "symbol",
        F.col("time").cast("date").alias("trading_date"),
        *[F.col(c.removesuffix("_price")).alias(c) for c in PRICE_COLS],
        F.col("volume").cast("bigint").alias("total_volume"),
        F.lower("source").alias("source"),
        *[c for c in history.columns if c not in _DOWNLOAD_COLS],
    )
    return valid_bars(apply_multiplier(sanitize_prices(renamed), multiplier))


_DOWNLOAD_COLS = ["symbol", "source", "time", "open", "high", "low", "close", "volume"]


def attach_exchange(df: DataFrame, listing: DataFrame) -> DataFrame:
    """Exchange label by symbol from the listing; ``Unknown`` when not listed."""
    labels = listing.select(
        "symbol", text.normalize_exchange(F.col("exchange")).alias("exchange")
    )
    # The listing is a map: one exchange per symbol, the greatest code if it repeats.
    labels = labels.groupBy("symbol").agg(F.max("exchange").alias("exchange"))
    joined = df.drop("exchange").join(labels, "symbol", "left")
    return joined.withColumn("exchange", F.coalesce("exchange", F.lit("Unknown")))


def encode_raw(df: DataFrame) -> DataFrame:
    """Storage form of raw bars: whole prices."""
    return _encode(df, prices.raw_price)


def encode_adjusted(df: DataFrame) -> DataFrame:
    """Storage form of adjusted bars: DECIMAL(18,2) prices."""
    return _encode(df, prices.adjusted_price)


def _encode(df, price):
    return df.select(
        F.col("symbol").cast("string"),
        F.col("trading_date").cast("date"),
        *[price(F.col(c)).alias(c) for c in PRICE_COLS],
        F.col("total_volume").cast("bigint"),
        F.col("exchange").cast("string"),
        F.col("source").cast("string"),
    )


def day_slice(df: DataFrame, day) -> DataFrame:
    return df.filter(F.col("trading_date") == F.lit(day).cast("date"))


def union_diagonal(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing in one frame is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
