"""Stored bar tables: Parquet by year, month and symbol bucket.

The month prunes by date, the bucket by symbol: a daily load rewrites one month,
a history reload rewrites the buckets of its symbols. Inside a file rows are
sorted by symbol and date, so row groups prune further.

A folder that lost all its rows holds one row without a symbol instead: a dynamic
overwrite replaces only folders that get a row. Readers here skip such rows.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.operators import clean, tables
from barloom.operators.keyed import drop_keys, landed
from barloom.schema import ADJ_SCHEMA, KEY, RAW_SCHEMA, ddl

LAYOUT = ["year", "month", "bucket"]
_LAYOUT_SCHEMA = "adjusted boolean, buckets int"


def stored_buckets(spark: SparkSession, path: str, adjusted: bool, buckets: int | None = None) -> int | None:
    """Bucket count of the table at ``path``; None before its first write.

    It is kept beside the table, so that every process reads and writes the same
    layout. A caller who asks for another one is refused.
    """
    try:
        stored = spark.read.schema(_LAYOUT_SCHEMA).json(f"{path}.layout").first()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if stored["adjusted"] != adjusted or buckets not in (None, stored["buckets"]):
        raise ValueError(f"{path} is stored as {stored.asDict()}, asked for {adjusted=}, {buckets=}")
    return stored["buckets"]


def settle_buckets(spark: SparkSession, path: str, adjusted: bool, buckets: int | None) -> int:
    """The same before a write; a new table needs a bucket count, which is stored."""
    stored = stored_buckets(spark, path, adjusted, buckets)
    if stored is not None:
        return stored
    if buckets is None:
        raise ValueError(f"{path} is new: give its bucket count")
    row = spark.createDataFrame([(adjusted, buckets)], _LAYOUT_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{path}.layout")
    return buckets


@dataclass(frozen=True)
class BarTable:
    """A table at ``path``; ``buckets`` has to be given once, before the first write."""

    path: str
    adjusted: bool = False
    buckets: int | None = None

    @property
    def schema(self):
        return ADJ_SCHEMA if self.adjusted else RAW_SCHEMA

    def encode(self, bars: DataFrame) -> DataFrame:
        return clean.encode_adjusted(bars) if self.adjusted else clean.encode_raw(bars)

    def read(self, spark: SparkSession, start=None, end=None, symbols=None) -> DataFrame:
        """Bars in a date range and of some symbols; both prune folders and rows."""
        rows = self._rows(spark)
        if start is not None:
            rows = rows.filter(_month_no() >= _month_of(start))
            rows = rows.filter(F.col("trading_date") >= F.lit(start).cast("date"))
        if end is not None:
            rows = rows.filter(_month_no() <= _month_of(end))
            rows = rows.filter(F.col("trading_date") <= F.lit(end).cast("date"))
        if symbols is not None:
            buckets = stored_buckets(spark, self.path, self.adjusted, self.buckets)
            if buckets is not None:
                rows = rows.filter(F.col("bucket").isin([_symbol_bucket(F.lit(s), buckets) for s in symbols]))
            rows = rows.filter(F.col("symbol").isin(list(symbols)))
        return rows.select(*self.schema.names)

    def truncate_load(self, bars: DataFrame) -> None:
        """The whole table becomes ``bars``."""
        self._write(self.encode(bars), "static")

    def append(self, bars: DataFrame) -> None:
        self._write(self.encode(bars), None)

    def replace_date(self, bars: DataFrame, day: date) -> None:
        """Replace one day. Without any bars nothing is touched."""
        self._replace_days(bars, {day})

    def replace_own_days(self, bars: DataFrame) -> None:
        """Replace every day that occurs in ``bars``, in one rewrite."""
        self._replace_days(bars, set())

    def _replace_days(self, bars, days):
        staged = self._stage(bars)
        own = {r[0] for r in staged.select("trading_date").distinct().collect()}
        if not own:
            return
        days = sorted(days or own)
        months = sorted({d.year * 100 + d.month for d in own.union(days)})
        touched = _month_no().isin(months)
        current = self._rows(bars.sparkSession).filter(touched)
        lost = current.filter(F.col("trading_date").isin(days))
        new = tables.replace_dates(current.select(*self.schema.names), staged, days)
        self._rewrite(new, touched, lost, staged)

    def replace_symbols(self, bars: DataFrame, staged: bool = False) -> None:
        """Replace the symbols in ``bars`` from their first common date on.

        ``staged`` says that the bars are encoded and written out already.
        """
        staged = bars if staged else self._stage(bars)
        start = staged.agg(F.min("trading_date")).first()[0]
        if start is None:
            return
        buckets = [r[0] for r in self._with_layout(staged).select("bucket").distinct().collect()]
        touched = F.col("bucket").isin(buckets) & (_month_no() >= _month_of(start))
        current = self._rows(bars.sparkSession).filter(touched)
        symbols = landed(staged.select("symbol").distinct(), "symbols")
        lost = current.filter(F.col("trading_date") >= F.lit(start)).join(symbols, "symbol", "left_semi")
        new = tables.replace_symbols(current.select(*self.schema.names), staged)
        self._rewrite(new, touched, lost, staged)

    def copy_raw(self, raw: "BarTable", days: list[date], excluded: DataFrame) -> None:
        """Replace the days by the raw table's bars, except for the excluded symbols."""
        if not days:
            return
        spark = excluded.sparkSession
        months = sorted({d.year * 100 + d.month for d in days})
        touched = _month_no().isin(months)
        current = self._rows(spark).filter(touched)
        keys = landed(excluded.select("symbol").distinct(), "excluded")
        lost = current.filter(F.col("trading_date").isin(days)).join(keys, "symbol", "left_anti")
        source = raw._rows(spark).filter(touched).select(*raw.schema.names)
        new = tables.copy_raw_to_adjusted(source, current.select(*self.schema.names), days, keys)
        copied = source.filter(F.col("trading_date").isin(days)).join(keys, "symbol", "left_anti")
        self._rewrite(new, touched, lost, copied)

    def upsert(self, bars: DataFrame, greatest: str | None = None) -> None:
        """Insert or update by (symbol, trading_date); nothing is deleted.

        With ``greatest`` the stored bar stays if it has more of that column.
        """
        staged = self._stage(bars)
        touched = landed(self._with_layout(staged).select(*LAYOUT).distinct(), "touched")
        # As literals the folders are pruned before the scan, the join trims the rest.
        months = [r[0] for r in touched.select(_month_no()).distinct().collect()]
        buckets = [r[0] for r in touched.select("bucket").distinct().collect()]
        current = self._rows(bars.sparkSession).filter(
            _month_no().isin(months) & F.col("bucket").isin(buckets)
        )
        current = current.join(touched, LAYOUT, "left_semi")
        new = tables.upsert(current.select(*self.schema.names), staged, greatest=greatest)
        self._write(new, "dynamic")

    def extent(self, spark: SparkSession, touched: Column | None = None) -> DataFrame:
        """(year, month, bucket, n_rows, last_day) of the folders that hold rows.

        It is read off the files' footers, without a scan of rows; ``touched`` is a
        condition on the folders. A table without files has no folder.
        """
        rows = self._files(_footer_session(spark))
        if touched is not None:
            rows = rows.filter(touched)
        found = rows.groupBy(*LAYOUT).agg(
            F.count("symbol").alias("n_rows"), F.max("trading_date").alias("last_day")
        )
        return found.filter(F.col("n_rows") > 0)

    def last_day(self, spark: SparkSession) -> DataFrame:
        """The last day stored, null for an empty table; from footers alone."""
        return self.extent(spark).agg(F.max("last_day").alias("trading_date"))

    def _rows(self, spark):
        return self._files(spark).filter(F.col("symbol").isNotNull())

    def _files(self, spark):
        try:
            return _read_parquet(spark, self.path, self.schema, LAYOUT)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema).withColumns({name: F.lit(1) for name in LAYOUT})

    def _stage(self, bars):
        """Incoming bars, written once; all later passes read the same rows."""
        return landed(self.encode(bars), "staged")

    def _with_layout(self, bars):
        buckets = settle_buckets(bars.sparkSession, self.path, self.adjusted, self.buckets)
        return bars.withColumns(
            {
                "year": F.year("trading_date"),
                "month": F.month("trading_date"),
                "bucket": _symbol_bucket(F.col("symbol"), buckets),
            }
        )

    def _rewrite(self, new, touched, lost, incoming):
        """Write the new content of the touched folders.

        A folder that loses as many rows as it has, and gets none, is emptied: it gets a row
        without a symbol in the same write, which is one job however many they are. Its row
        is dated on the first of the month, so that the last day in the footers stays right
        beside rows that are appended later.
        """
        before = self.extent(new.sparkSession, touched).select(*LAYOUT, F.col("n_rows").alias("_rows"))
        gone = lost.groupBy(*LAYOUT).agg(F.count("*").alias("_rows"))
        filled = self._with_layout(incoming).select(*LAYOUT).distinct()
        emptied = gone.join(before, [*LAYOUT, "_rows"]).join(filled, LAYOUT, "left_anti").drop("_rows")
        self._write(new, "dynamic", emptied.withColumn("trading_date", F.make_date("year", "month", F.lit(1))))

    def _write(self, bars, overwrite, emptied=None):
        """Write bars by layout. Rebalancing splits folders too big for one task."""
        laid_out = self._with_layout(bars)
        if emptied is not None:
            laid_out = laid_out.unionByName(emptied, allowMissingColumns=True)
        laid_out = laid_out.hint("rebalance", *LAYOUT)
        writer = laid_out.sortWithinPartitions(*LAYOUT, *KEY).write.partitionBy(*LAYOUT)
        writer = writer.option("compression", "snappy").mode("overwrite" if overwrite else "append")
        if overwrite:
            writer = writer.option("partitionOverwriteMode", overwrite)
        writer.parquet(self.path)


def sink_symbol_history(bars: DataFrame, path: str, buckets: int | None = None, staged: bool = False) -> None:
    """Store whole adjusted histories; a symbol in ``bars`` replaces its stored one.

    Histories lie in symbol buckets, not in a folder per symbol, so the number of
    folders does not grow with the market. Only the buckets of ``bars`` are rewritten.
    ``buckets`` has to be given for a new table; ``staged`` says that the bars are
    encoded and written out already.
    """
    spark = bars.sparkSession
    staged = bars if staged else landed(clean.encode_adjusted(bars), "staged")
    bucket = _symbol_bucket(F.col("symbol"), settle_buckets(spark, path, True, buckets))
    touched = [r[0] for r in staged.select(bucket).distinct().collect()]
    if not touched:
        return
    stored = _stored_histories(spark, path).filter(F.col("bucket").isin(touched))
    kept = drop_keys(stored.drop("bucket"), staged.select("symbol").distinct(), "symbol")
    new = kept.unionByName(staged).withColumn("bucket", bucket).hint("rebalance", "bucket")
    (
        new.sortWithinPartitions("bucket", *KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("bucket")
        .parquet(path)
    )


def read_symbol_history(spark: SparkSession, path: str, symbols: list[str] | None = None) -> DataFrame:
    rows = _stored_histories(spark, path)
    buckets = stored_buckets(spark, path, True) if symbols is not None else None
    if buckets is not None:
        own = [_symbol_bucket(F.lit(s), buckets) for s in symbols]
        rows = rows.filter(F.col("bucket").isin(own) & F.col("symbol").isin(list(symbols)))
    return rows.drop("bucket")


def _stored_histories(spark, path):
    try:
        return _read_parquet(spark, path, ADJ_SCHEMA, ["bucket"])
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ddl(ADJ_SCHEMA)}, bucket int")


def _symbol_bucket(symbol, buckets):
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def _read_parquet(spark, path, schema, folders):
    declared = ", ".join([ddl(schema), *[f"`{name}` int" for name in folders]])
    return spark.read.schema(declared).parquet(path)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings in which Spark answers counts and extremes from Parquet footers."""
    side = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            side.conf.set(name, value)
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return side


def _month_no():
    return F.col("year") * 100 + F.col("month")


def _month_of(day):
    d = day if isinstance(day, date) else date.fromisoformat(str(day))
    return d.year * 100 + d.month
