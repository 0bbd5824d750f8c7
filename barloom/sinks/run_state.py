"""State between runs, stored as versions.

Each run adds the folder ``version=<its moment>`` to every table and writes the
run row last. Readers follow the newest run row, so a run that broke off is not
seen, and repeating it with the same moment replaces its own folders only.

State that is absent or unreadable counts as empty: Spark logs a damaged file and skips
it. If that was the newest run row, the newest one that can be read holds.
"""

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.operators.keyed import last_by
from barloom.schema import (
    PENDING_SCHEMA,
    RUN_STATE_SCHEMA,
    SNAPSHOT_SCHEMA,
    STATE_SCHEMA,
    ddl,
)

_CACHE_SCHEMA = "symbol string, exchange string"


def version_of(as_of: datetime) -> str:
    """Version of a run; versions sort as their moments do."""
    return as_of.strftime("%Y%m%dT%H%M%S%f")


@dataclass(frozen=True)
class RunState:
    path: str

    def run(self, spark: SparkSession) -> DataFrame:
        """Metadata of the newest complete run; no row before the first one."""
        return self._newest(spark, "run", RUN_STATE_SCHEMA)

    def pending(self, spark: SparkSession) -> DataFrame:
        return self._newest(spark, "pending", PENDING_SCHEMA)

    def snapshot(self, spark: SparkSession) -> DataFrame:
        return self._newest(spark, "snapshot", SNAPSHOT_SCHEMA)

    def symbol_cache(self, spark: SparkSession) -> DataFrame:
        versions = _read(spark, f"{self.path}/symbols", _CACHE_SCHEMA)
        newest = versions.agg(F.max("version")).scalar()
        return versions.filter(F.col("version") == newest).drop("version")

    def save_symbol_cache(self, symbols: DataFrame, version: str) -> None:
        _write(symbols.select("symbol", "exchange"), f"{self.path}/symbols", version)

    def save(self, metadata: DataFrame, pending: DataFrame, snapshot: DataFrame, version: str):
        """Write a run's state; the run row makes it valid and goes last."""
        _write(snapshot.select(*SNAPSHOT_SCHEMA.names), f"{self.path}/snapshot", version)
        _write(pending.select("symbol"), f"{self.path}/pending", version)
        _write(metadata.select(*RUN_STATE_SCHEMA.names), f"{self.path}/run", version)

    def _newest(self, spark, name, schema):
        runs = _read(spark, f"{self.path}/run", RUN_STATE_SCHEMA)
        newest = runs.agg(F.max("version")).scalar()
        rows = _read(spark, f"{self.path}/{name}", schema)
        return rows.filter(F.col("version") == newest).drop("version")


@dataclass(frozen=True)
class KeyValueState:
    """Key to JSON text, a folder per key, so that a put reads nothing.

    Of entries that repeat a key in one put, the one with the greatest value stays.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        try:
            return _reader(spark).schema(STATE_SCHEMA).parquet(self.path).select("key", "value")
        except AnalysisException as problem:
            return _empty_if_absent(spark, problem, STATE_SCHEMA)

    def put(self, entries: DataFrame) -> None:
        (
            last_by(entries.select("key", "value"), ["key"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("key")
            .parquet(self.path)
        )


def _read(spark, path, schema):
    declared = f"{schema if isinstance(schema, str) else ddl(schema)}, version string"
    try:
        return _reader(spark).schema(declared).parquet(path)
    except AnalysisException as problem:
        return _empty_if_absent(spark, problem, declared)


def _reader(spark):
    return spark.read.option("ignoreCorruptFiles", True)


def _empty_if_absent(spark, problem, schema):
    if problem.getCondition() != "PATH_NOT_FOUND":
        raise problem
    return spark.createDataFrame([], schema)


def _write(df, path, version):
    (
        df.withColumn("version", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version")
        .parquet(path)
    )
