"""Adjusted history of all symbols that need it, in one job."""

from pyspark.sql import Column, DataFrame, functions as F

from barloom.operators import clean
from barloom.operators.keyed import landed, last_by, top_k
from barloom.schema import BAR_COLS, FALLBACK_SOURCES, KEY


def source_order(default: str, others=FALLBACK_SOURCES) -> list[str]:
    """The default source first, then the others, each once."""
    return list(dict.fromkeys(s.lower() for s in [default, *others] if s))


def source_fallback(history: DataFrame, sources: list[str]) -> DataFrame:
    """Per symbol only the rows of the first source that has any row for it.

    The choice is made on the rows as they came, before any cleaning.
    """
    ranks = F.create_map(*[F.lit(x) for i, s in enumerate(sources) for x in (s, i)])
    ranked = history.withColumn("_rank", F.try_element_at(ranks, F.lower("source")))
    ranked = ranked.filter(F.col("_rank").isNotNull())
    best = ranked.groupBy("symbol").agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["symbol", "_rank"], "left_semi").drop("_rank")


def history_scan(history: DataFrame, start, end) -> DataFrame:
    day = F.col("time")
    return history.filter((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))


def history_topk(history: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The latest ``limit`` rows per symbol, as a capped history request returns.

    ``order`` tells rows of the same day apart, then all other columns do; the
    greatest come first.
    """
    ties = [o.desc() for o in (*order, *map(F.col, history.columns))]
    return top_k(history, ["symbol"], limit, [F.col("time").desc(), *ties])


def gap_fill(history: DataFrame, board: DataFrame, today) -> DataFrame:
    """Add today's board row for symbols whose history ends before today.

    Symbols without any history get none: their reload has failed.
    """
    day = (today if isinstance(today, Column) else F.lit(today)).cast("date")
    ends = history.groupBy("symbol").agg(F.max("trading_date").alias("_end"))
    behind = ends.filter(F.col("_end") < day).select("symbol")
    rows = last_by(board, ["symbol"], F.col("trading_date"), keep=history.columns)
    fill = rows.join(behind, "symbol", "left_semi").withColumn("trading_date", day)
    return history.unionByName(fill)


def of_symbols(history, symbols: DataFrame) -> DataFrame:
    """The rows of ``symbols``: a semi join, or what a feed in buckets reads for them."""
    if isinstance(history, DataFrame):
        return history.join(symbols, "symbol", "left_semi")
    return history.of_symbols(symbols)


def adjusted_history(
    history,
    board: DataFrame,
    listing: DataFrame,
    symbols: DataFrame,
    today,
    multiplier: float | Column,
    sources: list[str],
    start,
    end,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Clean history of ``symbols``, filled up to ``today``, one bar per day.

    ``history`` is the feed's frame, or a ``BucketedHistory``, of which only folders of ``symbols`` are read.
    ``order`` names feed columns that tell repeated days of a symbol apart; the
    last one is kept, and a board row is later than all of them. All rows in the range
    count, however many. The rows of the symbols are written out, as the choice of a
    source looks at them twice, and so is the unique history for the fill; Spark then
    knows their size.
    """
    keys = landed(symbols.select("symbol").distinct(), "wanted-symbols")
    wanted = history_scan(of_symbols(history, keys), start, end)
    wanted = source_fallback(landed(wanted, "wanted"), sources)
    bars = clean.clean_download(wanted, multiplier)
    unordered = [c for c in bars.columns if c not in order]
    deduped = last_by(bars, KEY, *[F.col(c) for c in order], keep=unordered)
    # History is unique by day now, and the board row lies after its end.
    filled = gap_fill(landed(deduped, "history"), board, today)
    return clean.attach_exchange(filled, listing).select(*BAR_COLS)


def reload_outcome(symbols: DataFrame, adjusted: DataFrame) -> DataFrame:
    """(symbol, status): a reload is ``ok`` when it produced any bar, else ``failed``.

    Each symbol stands for itself; failures of some never hold back the others.
    """
    produced = adjusted.select("symbol").distinct().withColumn("_got", F.lit("ok"))
    joined = symbols.select("symbol").distinct().join(produced, "symbol", "left")
    return joined.select("symbol", F.coalesce("_got", F.lit("failed")).alias("status"))
