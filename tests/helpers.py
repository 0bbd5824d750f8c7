"""Small literal frames."""

from datetime import date

from barloom.schema import BAR_SCHEMA


def d(text):
    return date.fromisoformat(text)


def bar(symbol, day, price=10.0, volume=100, exchange="HNX", source="t"):
    """A valid bar; ``price`` is its close, a tuple gives all four prices."""
    o, h, l, c = price if isinstance(price, tuple) else (price, price, price, price)
    return (symbol, d(day) if isinstance(day, str) else day, o, h, l, c, volume, exchange, source)


def bars(spark, *rows):
    return spark.createDataFrame(list(rows), BAR_SCHEMA)
