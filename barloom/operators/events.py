"""Corporate actions and which symbols need their history again."""

from pyspark.sql import DataFrame, functions as F

from barloom.functions import dates, text
from barloom.operators.columns import compute_once
from barloom.operators.keyed import keep_keys
from barloom.schema import EVENT_CODES, EVENT_COLS


def corporate_actions(
    events: DataFrame, start, end, symbols: DataFrame | None = None
) -> DataFrame:
    """Dividend and issue events with an ex date in ``[start, end]``.

    ``events`` has the feed's columns, any of which may be null.
    """
    day = F.col("ex_date")
    wanted = F.col("eventCode").isNull() | F.col("eventCode").isin(EVENT_CODES)
    typed = compute_once(
        events.filter(wanted & F.col("exrightDate").isNotNull()),
        {
            "symbol": text.event_symbol(F.col("ticker"), F.col("organCode")),
            "ex_date": dates.event_date(F.col("exrightDate")),
        },
    )
    found = (
        typed.filter((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))
        .filter(text.is_ticker(F.col("symbol")))
        .select(
            "symbol",
            text.event_type(F.col("eventCode")).alias("event_type"),
            "ex_date",
            dates.event_date(F.col("recordDate")).alias("record_date"),
            F.col("exerciseRatio").cast("string").alias("ratio"),
        )
    )
    if symbols is not None:
        found = keep_keys(found, distinct_keys(symbols), "symbol")
    return found.select(*EVENT_COLS)


def distinct_keys(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def event_date_per_symbol(actions: DataFrame) -> DataFrame:
    """One ex date per symbol; with several the latest one counts."""
    return actions.groupBy("symbol").agg(F.max("ex_date").alias("ex_date"))


def reload_set(
    today_events: DataFrame, backfill_events: DataFrame, pending: DataFrame, today
) -> DataFrame:
    """Symbols to reload with their event date.

    Pending symbols of the last run win over backfill events, those over today's.
    Pending entries that are no ticker are dropped; the others are dated today.
    """
    day = today if hasattr(today, "alias") else F.lit(today)
    valid = pending.select(text.normalize_symbol(F.col("symbol")).alias("symbol"))
    valid = valid.filter(text.is_ticker(F.col("symbol")))

    def ranked(df, rank):
        return df.withColumn("_rank", F.lit(rank))

    union = (
        ranked(event_date_per_symbol(today_events), 0)
        .unionByName(ranked(event_date_per_symbol(backfill_events), 1))
        .unionByName(ranked(valid.withColumn("ex_date", day.cast("date")), 2))
    )
    return union.groupBy("symbol").agg(F.max_by("ex_date", "_rank").alias("ex_date"))


def pending_after(outcome: DataFrame) -> DataFrame:
    """Symbols the next run has to try again: those that failed."""
    return outcome.filter(F.col("status") != "ok").select("symbol")
