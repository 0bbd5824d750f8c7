"""Summary of a run as one row, and symbol lists as short text."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions import dates, text
from barloom.schema import REPORT_NONE, REPORT_SHOWN, STATUS_OK, STATUS_WARN


def report_symbols(df: DataFrame, by: list[str], shown: int = REPORT_SHOWN) -> DataFrame:
    """Per group the text of its first symbols and the count of the rest.

    Only ``shown`` symbols per group are ever gathered; the rest is just counted.
    """
    symbols = df.select(*by, "symbol").distinct()
    totals = symbols.groupBy(*by).agg(F.count("*").alias("symbols"))
    order = Window.partitionBy(*by).orderBy("symbol")
    first = symbols.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= shown)
    first = first.groupBy(*by).agg(F.array_sort(F.collect_list("symbol")).alias("_first"))
    joined = totals.join(first, by)
    line = text.shown_symbols(F.col("_first"), F.col("symbols"), shown)
    return joined.select(*by, "symbols", line.alias("text"))


def symbol_text(df: DataFrame, shown: int = REPORT_SHOWN) -> Column:
    """The same text for one whole frame, as a scalar subquery."""
    symbols = df.select("symbol").distinct()
    first = symbols.orderBy("symbol").limit(shown)
    first = first.agg(F.array_sort(F.collect_list("symbol")).alias("first"))
    total = symbols.agg(F.count("*").alias("n")).scalar()
    return text.shown_symbols(first.scalar(), total, shown)


def run_report(
    board: DataFrame,
    outcome: DataFrame,
    missing: DataFrame,
    as_of: Column,
    unfilled: DataFrame | None = None,
    absent: int = 0,
    broken: int | None = None,
) -> DataFrame:
    """One row about a daily run. ``outcome`` has (symbol, status) per reload.

    ``absent`` counts listed symbols that the board lacked. ``broken`` counts lines of feeds that could
    not be read; where it was not counted there is no such column.

    ``missing`` are the days that were back-filled, ``unfilled`` those of them that
    had no archive. Both are bounded by the calendar since the last run.
    """
    ok = outcome.filter(F.col("status") == "ok")
    failed = outcome.filter(F.col("status") != "ok")
    n_failed = failed.agg(F.count("*").alias("n")).scalar()
    return board.agg(
        F.max("trading_date").alias("trading_date"), F.count("*").alias("rows_loaded")
    ).select(
        "trading_date",
        "rows_loaded",
        F.lit(absent).cast("bigint").alias("absent_symbols"),
        *([] if broken is None else [F.lit(broken).cast("bigint").alias("broken_lines")]),
        dates.is_eod(F.col("trading_date"), as_of).alias("is_eod"),
        _day_text(missing).alias("missing_dates"),
        _day_text(missing.limit(0) if unfilled is None else unfilled).alias("unfilled_dates"),
        symbol_text(ok).alias("reloaded"),
        symbol_text(failed).alias("failed"),
        F.when(n_failed == 0, STATUS_OK).otherwise(STATUS_WARN).alias("status"),
    )


def _day_text(days):
    listed = F.array_sort(F.collect_set(F.col("trading_date").cast("string")))
    line = days.agg(F.array_join(listed, ", ").alias("d")).scalar()
    return F.when(line == "", REPORT_NONE).otherwise(line)
