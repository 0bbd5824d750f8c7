"""Where queries register themselves, with the SQL text that must agree."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from queries.feeds import Feeds, with_feeds

QUERIES: dict[str, Callable[[Feeds], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, feeds: list[str] | None = None, sql: str | None = None):
    """Register a query; ``feeds`` are the SQL feeds its text ``sql`` reads."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_feeds(feeds or [], sql)
        return build

    return register
