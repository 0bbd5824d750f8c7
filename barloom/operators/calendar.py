"""Trading days, holidays and what a run has to do on a given day."""

from pyspark.sql import DataFrame, functions as F

from barloom.functions import dates, text
from barloom.operators.keyed import drop_keys


def custom_holidays(entries: DataFrame, column: str = "entries") -> DataFrame:
    """Dates from comma separated text with ``-`` or ``/``; bad entries are skipped."""
    entry = F.explode(F.split(F.col(column), ",")).alias("entry")
    day = F.try_to_date(F.replace(text.strip(F.col("entry")), F.lit("/"), F.lit("-")), "yyyy-M-d")
    return entries.select(entry).select(day.alias("holiday")).dropna().distinct()


def holiday_calendar(holidays: DataFrame, custom: DataFrame | None = None) -> DataFrame:
    """Distinct holiday dates of the national list and the custom one."""
    days = holidays.select(F.col("holiday").cast("date").alias("holiday"))
    if custom is not None:
        days = days.unionByName(custom.select("holiday"))
    return days.dropna().distinct()


def trading_days(days: DataFrame, holidays: DataFrame, column: str = "trading_date") -> DataFrame:
    """Rows whose date is a weekday and no holiday."""
    closed = holidays.select(F.col("holiday").alias(column)).distinct()
    return drop_keys(days.filter(dates.is_weekday(F.col(column))), closed, column)


def run_gate(days: DataFrame, holidays: DataFrame, force: bool = False) -> DataFrame:
    """Per date: ``run``, or the reason to skip. ``force`` overrides the reason."""
    closed = holidays.select(F.col("holiday").alias("trading_date"), F.lit(True).alias("_closed"))
    reason = (
        F.when(F.lit(force), "run")
        .when(~dates.is_weekday(F.col("trading_date")), "skip_weekend")
        .when(F.col("_closed"), "skip_holiday")
        .otherwise("run")
    )
    marked = days.join(closed.distinct(), "trading_date", "left")
    return marked.withColumn("gate", reason).drop("_closed")


def run_decisions(states: DataFrame) -> DataFrame:
    """Decision per row of (t0_max, last_successful_run, is_eod)."""
    last = dates.parse_run_date(F.col("last_successful_run"))
    decision = dates.run_decision(F.col("t0_max"), last, F.col("is_eod"))
    return states.withColumn("decision", decision)


def missing_days(states: DataFrame, holidays: DataFrame) -> DataFrame:
    """Trading days between the last run and ``t0_max`` that were never loaded.

    ``states`` has (t0_max, last_successful_run, is_eod) and any key columns.
    """
    last = dates.parse_run_date(F.col("last_successful_run"))
    span = dates.days_between_runs(last, F.col("is_eod"), F.col("t0_max"))
    keys = [c for c in states.columns if c not in ("t0_max", "last_successful_run", "is_eod")]
    return trading_days(states.select(*keys, F.explode(span).alias("trading_date")), holidays)


def absent_days(days: DataFrame, loaded: DataFrame) -> DataFrame:
    """Wanted days for which nothing was loaded."""
    return drop_keys(days, loaded.select("trading_date").distinct(), "trading_date")
