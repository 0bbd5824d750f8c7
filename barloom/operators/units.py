"""Vote on the price unit of the board and of the history feed."""

import re

from pyspark.sql import DataFrame, functions as F

from barloom.functions import prices, text
from barloom.schema import (
    DEFAULT_BENCHMARKS,
    DEFAULT_BOARD_MULTIPLIER,
    DEFAULT_HISTORY_MULTIPLIER,
    TICKER_PATTERN,
)


def benchmark_tickers(configured) -> list[str]:
    """Configured tickers that are well formed, or the default ones when none is."""
    if isinstance(configured, str):
        configured = configured.split(",")
    clean = [str(t).strip().upper() for t in configured or []]
    return [t for t in clean if re.match(TICKER_PATTERN, t)] or list(DEFAULT_BENCHMARKS)


def vote_candidates(symbols: DataFrame, benchmarks: list[str]) -> DataFrame:
    """Listed benchmark tickers; if none is listed, the first 3 character symbol."""
    listed = symbols.filter(F.col("symbol").isin(benchmarks)).select("symbol").distinct()
    any_listed = listed.agg((F.count("*") > 0).alias("any")).scalar()
    first = (
        symbols.filter(F.length("symbol") == 3)
        .agg(F.min("symbol").alias("symbol"))
        .filter(F.col("symbol").isNotNull() & ~any_listed)
    )
    return listed.unionByName(first)


def unit_vote(
    symbols: DataFrame, board: DataFrame, history: DataFrame, benchmarks: list[str], as_of
) -> DataFrame:
    """One row (board_multiplier, history_multiplier).

    Each candidate votes once per feed with its last price: in thousands if below
    the threshold. The most frequent multiplier wins, the lower one on a tie.
    ``board`` has (symbol, time, close_price) as landed, ``history`` (symbol, time, close).
    """
    board = board.withColumn("symbol", text.normalize_symbol(F.col("symbol")))
    # At most one row per configured ticker, so the broadcast is bounded by the setting.
    candidates = F.broadcast(vote_candidates(symbols, benchmarks))
    end = F.lit(as_of).cast("date")
    week = history.filter(F.col("time").between(F.date_sub(end, 7), end))
    on_board = _last_price(board.join(candidates, "symbol", "left_semi"), "close_price")
    in_history = _last_price(week.join(candidates, "symbol", "left_semi"), "close")
    votes = _votes(on_board, "board").unionByName(_votes(in_history, "history"))
    counted = votes.groupBy("feed", "multiplier").agg(F.count("*").alias("n"))

    def winner(feed, default):
        ranked = F.max_by(
            F.when(F.col("feed") == feed, F.col("multiplier")),
            F.when(F.col("feed") == feed, F.struct("n", -F.col("multiplier"))),
        )
        return F.coalesce(ranked, F.lit(default)).alias(f"{feed}_multiplier")

    return counted.agg(
        winner("board", DEFAULT_BOARD_MULTIPLIER),
        winner("history", DEFAULT_HISTORY_MULTIPLIER),
    )


def _last_price(df, column):
    return df.groupBy("symbol").agg(F.max_by(column, "time").alias("price"))


def _votes(last, feed):
    factor = prices.unit_factor(F.col("price"))
    return last.select(F.lit(feed).alias("feed"), factor.alias("multiplier")).dropna()
