"""One Spark query and one DuckDB text per operator, over the given tables."""
