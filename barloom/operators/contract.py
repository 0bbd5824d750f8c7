"""The data contract of a bar: report breaches, list them, or refuse them."""

from pyspark.sql import DataFrame, functions as F

from barloom.functions import prices


def contract_report(df: DataFrame) -> DataFrame:
    """(rule, violations) for every rule, in one pass over the bars."""
    rules = {**prices.contract_rules(), **prices.low_rules()}
    counts = df.agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counts.select(F.inline(F.array(*pairs)))


def contract_rows(df: DataFrame) -> DataFrame:
    """Rows that break the contract, with the names of the broken rules."""
    broken = F.concat_ws(
        ",", *[F.when(~ok, F.lit(name)) for name, ok in prices.contract_rules().items()]
    )
    return df.withColumn("broken_rules", broken).filter(F.col("broken_rules") != "")


def enforce_contract(df: DataFrame) -> DataFrame:
    """The same rows, but the job that reads them fails on the first breach.

    The check runs inside the tasks that use the rows, so it needs no extra pass.
    """
    good = prices.all_of(prices.contract_rules().values())
    message = F.concat(
        F.lit("data contract broken by "),
        F.coalesce("symbol", F.lit("null")),
        F.lit(" on "),
        F.coalesce(F.col("trading_date").cast("string"), F.lit("null")),
    )
    return df.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
