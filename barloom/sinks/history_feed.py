"""The landed history feed in folders by symbol bucket: a reload reads the folders of its symbols."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barloom.schema import HISTORY_FEED_SCHEMA, ddl
from barloom.sinks.bar_table import _read_parquet, _symbol_bucket, settle_buckets, stored_buckets

BUCKET = "symbol_bucket"


@dataclass(frozen=True)
class BucketedHistory:
    """A feed at ``path``; ``buckets`` has to be given once, before the first batch.

    Takes the place of the feed's frame in ``adjusted_history`` and ``run_daily``. ``schema`` may have more
    columns than the feed's own.
    """

    spark: SparkSession
    path: str
    buckets: int | None = None
    schema: StructType = HISTORY_FEED_SCHEMA

    def append(self, batch: DataFrame) -> None:
        """Add landed rows, sorted by symbol and day within a bucket. A null symbol lies in a bucket as well."""
        bucket = _symbol_bucket(F.col("symbol"), settle_buckets(self.spark, self.path, True, self.buckets))
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        rows = rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        rows.sortWithinPartitions(BUCKET, "symbol", "time").write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; none before the first batch."""
        return self._stored().drop(BUCKET)

    def of_symbols(self, symbols: DataFrame) -> DataFrame:
        """The rows of ``symbols`` (distinct column ``symbol``).

        The bucket is joined too, and Spark prunes folders by the buckets of the symbols when it
        broadcasts them. It only does so for a side that a filter narrows, so there is one that all pass.
        """
        buckets = stored_buckets(self.spark, self.path, True, self.buckets)
        if buckets is None:
            return self.read()
        keys = symbols.select("symbol", _symbol_bucket(F.col("symbol"), buckets).alias(BUCKET)).filter(F.col(BUCKET) >= 0)
        return self._stored().join(keys, [BUCKET, "symbol"], "left_semi").drop(BUCKET)

    def _stored(self) -> DataFrame:
        try:
            return _read_parquet(self.spark, self.path, self.schema, [BUCKET])
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{ddl(self.schema)}, {BUCKET} int")
