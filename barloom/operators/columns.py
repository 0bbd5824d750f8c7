"""Adding columns that are costly to compute."""

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``withColumns``, but each expression is evaluated once per row.

    Catalyst moves a filter below a plain projection and computes the expression
    again for each mention in the filter: parsing or rounding would run a dozen
    times per bar. It does not move filters on generated columns below a generator,
    so the columns come from a generator of one row.
    """
    kept = [c for c in df.columns if c not in new]
    row = F.struct(*[expr.alias(name) for name, expr in new.items()])
    names = df.columns + [c for c in new if c not in df.columns]
    return df.select(*kept, F.inline(F.array(row))).select(*names)
