"""Joins and rankings by key that stay safe when keys are many or one is hot.

How a join is done is left to Spark: it knows the size of a written table, and adaptive
execution sees that of a shuffled one and splits hot keys.
"""

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def keep_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Semi join. Spark broadcasts the keys if their size is known to fit, else it shuffles."""
    return df.join(keys, on, "left_semi").select(*df.columns)


def drop_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Anti join. Unlike ``NOT IN``, null keys on the right remove nothing."""
    return df.join(keys, on, "left_anti").select(*df.columns)


def last_by(
    df: DataFrame, keys: list[str], *order: Column, keep: list[str] | None = None
) -> DataFrame:
    """One row per key, the one with the greatest ``order``; ``keep`` names its columns.

    An aggregate rather than a window: every task first reduces its own rows to
    one per key, so a key that holds a third of the table costs one row per task
    in the shuffle and is never sorted in one place. Rows that tie under ``order``
    are told apart by their other columns, so the choice does not depend on luck.
    """
    names = keep or df.columns
    rest = [c for c in names if c not in keys]
    ranked = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], *rest)
    out = df.groupBy(*keys).agg(F.max(ranked).alias("_last"))
    return out.select(*[c if c in keys else F.col("_last")[c].alias(c) for c in names])


_SLICES = 64


def top_k(
    df: DataFrame, keys: list[str], k: int | Column, order: list[Column], bound: int | None = None
) -> DataFrame:
    """The first ``k`` rows per key under ``order``, in two steps.

    Each key is first cut into slices of input partitions and every slice is trimmed
    to ``k`` rows; if ``k`` is small, Spark trims each input partition to ``k`` rows
    of the key before that shuffle. Only the rest, at most slices times ``k`` rows of
    a key, meets in one task. ``k`` may be a column that is constant per key;
    ``bound`` is then the greatest it can be.
    """
    limit = k if bound is None else bound
    slices = Window.partitionBy(*keys, "_slice").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    spread = F.pmod(F.spark_partition_id(), F.lit(_SLICES))
    trimmed = df.withColumn("_slice", spread).withColumn("_rank", F.row_number().over(slices))
    trimmed = trimmed.filter(F.col("_rank") <= limit).drop("_slice", "_rank")
    ranked = trimmed.withColumn("_rank", F.row_number().over(whole))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def landed(df: DataFrame, name: str = "landed") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: later steps do not repeat the work and a lost executor
    cannot change the rows. Other than ``checkpoint`` it runs the plan only once,
    and the result knows its size, so Spark itself broadcasts a small one.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Where it is unset, a folder of this application below the warehouse, which all
    executors share as well.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        folder = f"{warehouse}/_intermediate/{context.applicationId}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.urandom(8).hex()}"
