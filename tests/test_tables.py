"""Adjusted history, table maintenance and the stored tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.operators import adjust, clean, tables, units
from barloom.schema import HISTORY_FEED_SCHEMA, KEY
from barloom.sinks.bar_table import BarTable, read_symbol_history, sink_symbol_history
from barloom.sinks.history_feed import BucketedHistory
from barloom.sinks.run_state import KeyValueState, RunState
from tests.helpers import bar, bars, d


def feed(spark, *rows):
    full = [(s, src, d(day), p, p, p, p, 1) for s, src, day, p in rows]
    return spark.createDataFrame(full, HISTORY_FEED_SCHEMA)


def test_source_order():
    assert adjust.source_order("VCI") == ["vci", "kbs", "msn"]
    assert adjust.source_order("msn") == ["msn", "vci", "kbs"]


def test_source_fallback_chooses_before_cleaning(spark, rows):
    history = feed(
        spark,
        ("A", "VCI", "2024-01-02", -1.0),
        ("A", "kbs", "2024-01-02", 5.0),
        ("B", "msn", "2024-01-02", 6.0),
        ("B", "KBS", "2024-01-02", 7.0),
        ("C", "other", "2024-01-02", 8.0),
    )
    chosen = adjust.source_fallback(history, ["vci", "kbs", "msn"])
    assert rows(chosen, "symbol", "source") == [("A", "VCI"), ("B", "KBS")]
    assert rows(clean.clean_download(chosen, 1000.0), "symbol", "close_price") == [("B", 7000.0)]


@pytest.mark.parametrize("limit", [1, 7, 130, 400, 5000])
@pytest.mark.parametrize("days", [300, 4])
def test_top_k_against_sorting(spark, limit, days):
    """One symbol and few days hold most rows."""
    rng = random.Random(limit)
    data = [("HOT" if rng.random() < 0.7 else f"S{rng.randrange(5)}", rng.randrange(days), i) for i in range(800)]
    df = spark.createDataFrame(data, "symbol string, time int, seq int").repartition(5)
    got = sorted(tuple(r) for r in adjust.history_topk(df, limit, F.col("seq")).collect())
    want = []
    for symbol in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == symbol), key=lambda r: (-r[1], -r[2]))
        want += own[:limit]
    assert got == sorted(want)


def test_gap_fill(spark, rows):
    history = bars(spark, bar("A", "2024-01-29"), bar("B", "2024-01-30"), bar("A", "2024-01-26"))
    board = bars(spark, bar("A", "2024-01-30", 7.0), bar("B", "2024-01-30", 8.0), bar("C", "2024-01-30", 9.0))
    filled = adjust.gap_fill(history, board, d("2024-01-31"))
    assert rows(filled.filter("close_price < 10"), *KEY, "close_price") == [
        ("A", d("2024-01-31"), 7.0),
        ("B", d("2024-01-31"), 8.0),
    ]
    today = adjust.gap_fill(history, board, d("2024-01-30"))
    assert rows(today.filter("close_price < 10"), *KEY) == [("A", d("2024-01-30"))]


def test_adjusted_history(spark, rows):
    history = feed(
        spark,
        ("A", "VCI", "2024-01-26", 1.0),
        ("A", "VCI", "2024-01-29", 2.0),
        ("A", "kbs", "2024-01-30", 9.0),
        ("B", "kbs", "2024-01-30", 3.0),
        ("D", "VCI", "2024-01-30", -3.0),
        ("X", "VCI", "2024-01-30", 3.0),
    )
    board = bars(spark, bar("A", "2024-01-30", 5000.0, source="vci"), bar("C", "2024-01-30"), bar("D", "2024-01-30"))
    listing = spark.createDataFrame([("A", "HSX")], "symbol string, exchange string")
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    got = adjust.adjusted_history(
        history, board, listing, wanted, d("2024-01-30"), 1000.0, ["vci", "kbs"], "2000-01-01", "2024-01-30"
    )
    assert rows(got, *KEY, "close_price", "exchange", "source") == [
        ("A", d("2024-01-26"), 1000.0, "HoSE", "vci"),
        ("A", d("2024-01-29"), 2000.0, "HoSE", "vci"),
        ("A", d("2024-01-30"), 5000.0, "HoSE", "vci"),
        ("B", d("2024-01-30"), 3000.0, "Unknown", "kbs"),
    ]
    outcome = adjust.reload_outcome(wanted, got)
    assert rows(outcome) == [("A", "ok"), ("B", "ok"), ("C", "failed"), ("D", "failed")]


def test_a_reload_reads_only_the_buckets_of_its_symbols(spark, rows, tmp_path):
    names = [f"S{k}" for k in range(40)]
    history = BucketedHistory(spark, str(tmp_path / "feed"), 8)
    wanted = spark.createDataFrame([("S1",), ("S2",), ("none",), (None,)], "symbol string")
    assert history.read().count() == history.of_symbols(wanted).count() == 0
    history.append(feed(spark, *[(s, "VCI", "2024-01-26", 1.0) for s in [*names, None]]))
    history.append(feed(spark, *[(s, "VCI", "2024-01-29", 2.0) for s in names]))
    assert history.read().count() == 81 and history.read().columns == HISTORY_FEED_SCHEMA.names
    with pytest.raises(ValueError, match="asked for"):
        BucketedHistory(spark, history.path, 4).of_symbols(wanted)
    listing = spark.createDataFrame([("S1", "HSX")], "symbol string, exchange string")

    def rebuilt(source):
        board = bars(spark, bar("S1", "2024-01-30", 5000.0))
        range_ = (d("2024-01-30"), 1000.0, ["vci"], "2000-01-01", "2024-01-30")
        return rows(adjust.adjusted_history(source, board, listing, wanted, *range_))

    before = rebuilt(history.read())
    assert len(before) == 5 and rebuilt(history) == before
    plan = history.of_symbols(wanted)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(symbol_bucket" in plan
    # Files of other buckets are not opened: they may hold anything.
    own = {r[0] for r in wanted.select(F.expr("cast(pmod(xxhash64(symbol), 8) as int)")).collect()}
    spoilt = [f for f in (tmp_path / "feed").glob("symbol_bucket=*/*.parquet") if int(f.parent.name.split("=")[1]) not in own]
    for file in spoilt:
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"not a table")
    assert spoilt and rebuilt(history) == before


def test_the_unit_vote_reads_a_feed_in_buckets(spark, tmp_path):
    history = BucketedHistory(spark, str(tmp_path / "feed"), 8)
    history.append(feed(spark, ("AAA", "vci", "2024-01-29", 20.0), ("BBB", "vci", "2024-01-29", 30_000.0)))
    listed = spark.createDataFrame([("AAA",), ("BBB",)], "symbol string")
    board = spark.createDataFrame([], "symbol string, time timestamp, close_price double")
    for benchmarks in (["AAA"], ["BBB"], ["CCC"]):  # none listed: the first symbol of three characters
        quoted = history.of_symbols(units.vote_candidates(listed, benchmarks))
        got = units.unit_vote(listed, board, quoted, benchmarks, d("2024-01-30")).first()
        assert got == units.unit_vote(listed, board, history.read(), benchmarks, d("2024-01-30")).first()


def test_a_long_history_is_rebuilt_in_whole(spark):
    """No request size cuts it, and invalid rows take no room of others."""
    days = [f"{y}-{m:02d}-{day:02d}" for y in range(2000, 2024) for m in range(1, 13) for day in range(1, 29)]
    history = feed(spark, *[("A", "VCI", day, -1.0 if k % 3 == 0 else 1.0) for k, day in enumerate(days)])
    listing = spark.createDataFrame([("A", "HSX")], "symbol string, exchange string")
    wanted = spark.createDataFrame([("A",)], "symbol string")
    got = adjust.adjusted_history(
        history, bars(spark, bar("Z", "2024-01-30")), listing, wanted, d("2024-01-30"), 1.0, ["vci"], "2000-01-01", "2024-01-30"
    )
    assert got.count() == sum(k % 3 != 0 for k in range(len(days)))


def test_history_rows_that_tie_are_told_apart_by_all_columns(spark):
    rows = [("A", 1, n % 3, f"x{n}") for n in range(6)]
    got = [
        adjust.history_topk(spark.createDataFrame(data, "symbol string, time int, seq int, note string"), 1, F.col("seq")).first()
        for data in (rows, rows[::-1])
    ]
    assert got[0] == got[1] == ("A", 1, 2, "x5")


@pytest.fixture
def stored(spark):
    return bars(
        spark,
        bar("A", "2023-12-29", 1.0),
        bar("A", "2024-01-29", 2.0),
        bar("A", "2024-01-30", 3.0),
        bar("B", "2024-01-30", 4.0),
        bar("C", "2024-01-29", 5.0),
    )


def twice(apply, target, *args):
    once = apply(target, *args)
    again = apply(once, *args)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    return once


def test_replace_date(spark, rows, stored):
    fresh = bars(spark, bar("B", "2024-01-30", 9.0), bar("D", "2024-01-30", 8.0))
    got = rows(twice(tables.replace_date, stored, fresh, d("2024-01-30")), *KEY, "close_price")
    assert got == [
        ("A", d("2023-12-29"), 1.0),
        ("A", d("2024-01-29"), 2.0),
        ("B", d("2024-01-30"), 9.0),
        ("C", d("2024-01-29"), 5.0),
        ("D", d("2024-01-30"), 8.0),
    ]


def test_replace_symbols_uses_the_first_date_of_the_batch(spark, rows, stored):
    fresh = bars(spark, bar("A", "2024-01-30", 9.0), bar("C", "2024-01-29", 8.0))
    got = rows(twice(tables.replace_symbols, stored, fresh), *KEY, "close_price")
    # The row of A on the 29th goes although A's own batch starts on the 30th.
    assert got == [
        ("A", d("2023-12-29"), 1.0),
        ("A", d("2024-01-30"), 9.0),
        ("B", d("2024-01-30"), 4.0),
        ("C", d("2024-01-29"), 8.0),
    ]
    each = rows(tables.replace_symbols(stored, fresh, per_symbol=True), *KEY, "close_price")
    assert ("A", d("2024-01-29"), 2.0) in each and len(each) == 5
    assert tables.replace_symbols(stored, fresh.filter("false")).count() == 5


def test_copy_raw_to_adjusted(spark, rows, stored):
    raw = clean.encode_raw(stored)
    adjusted = clean.encode_adjusted(stored.withColumn("close_price", F.col("close_price") / 2))
    excluded = spark.createDataFrame([("B",), (None,)], "symbol string")
    days = [d("2024-01-30")]
    copied = tables.copy_raw_to_adjusted(raw, adjusted, days, excluded)
    again = tables.copy_raw_to_adjusted(raw, copied, days, excluded)
    got = [(s, day, float(p)) for s, day, p in rows(copied, *KEY, "close_price")]
    assert got == [
        ("A", d("2023-12-29"), 0.5),
        ("A", d("2024-01-29"), 1.0),
        ("A", d("2024-01-30"), 3.0),
        ("B", d("2024-01-30"), 2.0),
        ("C", d("2024-01-29"), 2.5),
    ]
    assert rows(again) == rows(copied)
    assert copied.schema == adjusted.schema
    assert tables.copy_raw_to_adjusted(raw, adjusted, [], excluded) is adjusted


def test_upsert_never_deletes(spark, rows, stored):
    fresh = bars(spark, bar("B", "2024-01-30", 9.0), bar("E", "2024-01-30", 8.0), bar("E", "2024-01-30", 7.0))
    got = tables.upsert(stored, fresh, KEY, [F.col("close_price")])
    assert rows(got.filter("trading_date = '2024-01-30'"), "symbol", "close_price") == [
        ("A", 3.0),
        ("B", 9.0),
        ("E", 8.0),
    ]
    assert got.count() == 6


def test_state(spark, rows, tmp_path):
    state = spark.createDataFrame([("k", "1"), ("x", "2")], "key string, value string")
    put = tables.state_put(state, spark.createDataFrame([("k", "3")], state.schema))
    assert rows(tables.state_get(put, "k")) == [("3",)]
    assert rows(tables.state_get(put, "nope")) == []
    kv = KeyValueState(str(tmp_path / "kv"))
    assert rows(kv.read(spark)) == []
    kv.put(state)
    kv.put(spark.createDataFrame([("k", "3"), ("2024", "a/b"), ("k", "2")], state.schema))
    assert rows(kv.read(spark)) == [("2024", "a/b"), ("k", "3"), ("x", "2")]


def test_run_state_follows_the_newest_complete_run(spark, rows, tmp_path):
    state = RunState(str(tmp_path))
    assert state.run(spark).count() == state.snapshot(spark).count() == state.pending(spark).count() == 0
    from barloom.schema import RUN_STATE_SCHEMA, SNAPSHOT_SCHEMA

    def run(day):
        return spark.createDataFrame([(day, True, 1)], RUN_STATE_SCHEMA)

    def snap(symbol):
        return spark.createDataFrame([(symbol, "HNX", d("2024-01-30"), 1, 1, 1, 1, 1.0, 1)], SNAPSHOT_SCHEMA)

    pending = spark.createDataFrame([("A",)], "symbol string")
    state.save(run("2024-01-29"), pending, snap("A"), "20240129")
    state.save(run("2024-01-30"), pending.filter("false"), snap("B"), "20240130")
    assert rows(state.run(spark), "last_successful_run") == [("2024-01-30",)]
    assert rows(state.snapshot(spark), "symbol") == [("B",)]
    assert rows(state.pending(spark)) == []
    # A run that broke off before its run row is not seen.
    snap("C").withColumn("version", F.lit("20240131")).write.mode("append").partitionBy("version").parquet(
        f"{state.path}/snapshot"
    )
    assert rows(state.snapshot(spark), "symbol") == [("B",)]


def test_unreadable_state_counts_as_empty(spark, rows, tmp_path):
    state, schema = RunState(str(tmp_path / "state")), "last_successful_run string, is_eod boolean, total_tickers long"
    for version, day in (("1", "2024-01-29"), ("2", "2024-01-30")):
        run = spark.createDataFrame([(day, True, 1)], schema)
        pending = spark.createDataFrame([(f"P{version}",)], "symbol string")
        state.save(run, pending, state.snapshot(spark), version)
    values = KeyValueState(str(tmp_path / "values"))
    values.put(spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string"))

    def damage(folder):
        found = list(folder.rglob("*.parquet"))
        for file in found:
            file.write_bytes(b"PAR1 cut off")
        assert found

    damage(tmp_path / "state" / "pending" / "version=2")
    damage(tmp_path / "values" / "key=a")
    assert rows(state.pending(spark)) == [] and rows(state.run(spark), "last_successful_run") == [("2024-01-30",)]
    assert rows(values.read(spark)) == [("b", "2")]
    damage(tmp_path / "state" / "run" / "version=2")
    assert rows(state.run(spark), "last_successful_run") == [("2024-01-29",)]
    assert rows(state.pending(spark)) == [("P1",)]
    damage(tmp_path / "state" / "run")
    assert rows(state.run(spark)) == [] and rows(state.pending(spark)) == []


@pytest.fixture
def table(tmp_path):
    return BarTable(str(tmp_path / "raw"), buckets=3)


def test_the_layout_outlives_the_process(spark, tmp_path):
    path = str(tmp_path / "raw")
    names = [f"S{n}" for n in range(10)]
    with pytest.raises(ValueError, match="give its bucket count"):
        BarTable(path).truncate_load(bars(spark, bar("S1", "2024-01-30")))
    BarTable(path, buckets=4).truncate_load(bars(spark, *[bar(n, "2024-01-30") for n in names]))
    assert BarTable(path).read(spark, symbols=names).count() == 10
    BarTable(path).upsert(bars(spark, *[bar(n, "2024-01-30", 7.0) for n in names]))
    assert BarTable(path).read(spark).count() == 10
    for wrong in (BarTable(path, buckets=64), BarTable(path, adjusted=True)):
        with pytest.raises(ValueError, match="is stored as"):
            wrong.upsert(bars(spark, bar("S1", "2024-01-30")))
    with pytest.raises(ValueError, match="is stored as"):
        BarTable(path, buckets=64).read(spark, symbols=names)


def test_bars_of_other_days_replace_their_own_key(spark, rows, table, stored):
    """A board holds symbols that have not traded today; storing it again adds nothing."""
    table.truncate_load(stored)
    board = bars(spark, bar("A", "2024-01-30", 9.0), bar("C", "2024-01-29", 8.0), bar("Q", "2023-12-29", 7.0))
    for _ in range(3):
        table.replace_date(board, d("2024-01-30"))
        assert rows(table.read(spark), *KEY, "close_price") == [
            ("A", d("2023-12-29"), 1),
            ("A", d("2024-01-29"), 2),
            ("A", d("2024-01-30"), 9),
            ("C", d("2024-01-29"), 8),
            ("Q", d("2023-12-29"), 7),
        ]


def test_the_greater_volume_stays(spark, rows, table):
    for price, volume in ((1.0, 100), (2.0, 300), (3.0, 200), (4.0, 300)):
        table.upsert(bars(spark, bar("A", "2024-01-30", price, volume)), greatest="total_volume")
    assert rows(table.read(spark), "close_price", "total_volume") == [(4, 300)]


def test_stored_table_starts_empty(spark, table):
    assert table.read(spark).count() == 0
    table.replace_date(bars(spark, bar("A", "2024-01-30")), d("2024-01-30"))
    assert table.read(spark).count() == 1


def test_stored_replace_date_empties_folders(spark, rows, table, stored):
    """A folder that loses its only rows must not show them again."""
    table.truncate_load(stored)
    fresh = bars(spark, bar("Z", "2024-01-30", 9.0))
    for _ in range(2):
        table.replace_date(fresh, d("2024-01-30"))
        assert rows(table.read(spark), *KEY, "close_price") == [
            ("A", d("2023-12-29"), 1),
            ("A", d("2024-01-29"), 2),
            ("C", d("2024-01-29"), 5),
            ("Z", d("2024-01-30"), 9),
        ]
    table.replace_date(fresh.filter("false"), d("2024-01-29"))
    assert table.read(spark).count() == 4


def test_extent_comes_from_footers(spark, rows, table, stored):
    assert rows(table.last_day(spark)) == [(None,)] and rows(table.extent(spark)) == []
    table.truncate_load(stored)
    plan = table.last_day(spark)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(symbol), MAX(trading_date)]" in plan and "PushedGroupBy" in plan
    assert rows(table.last_day(spark)) == [(d("2024-01-30"),)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    extent = table.extent(spark)
    assert extent.agg({"n_rows": "sum"}).first()[0] == table.read(spark).count() == stored.count()


def test_emptied_folders_take_no_job_of_their_own(spark, rows, tmp_path):
    """All buckets of a day but one lose their rows; the last day is right with and without later rows."""
    jobs, context = {}, spark.sparkContext
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", 1000)  # listing takes no job either way
    for buckets in (5, 25):
        table = BarTable(str(tmp_path / f"raw{buckets}"), buckets=buckets)
        table.truncate_load(bars(spark, *[bar(f"S{n}", day) for n in range(200) for day in ("2023-12-29", "2024-01-30")]))
        folders = table.extent(spark).count()
        assert folders > buckets
        context.setJobGroup(f"empty{buckets}", "")
        try:
            table.replace_date(bars(spark, bar("Z", "2024-01-30")), d("2024-01-30"))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        jobs[buckets] = len(context.statusTracker().getJobIdsForGroup(f"empty{buckets}"))
        assert rows(table.read(spark, "2024-01-01"), "symbol") == [("Z",)]
        assert table.extent(spark).count() == folders // 2 + 1 and table.read(spark).count() == 201
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.threshold")
    assert jobs[5] == jobs[25], jobs
    # Once more on folders that are empty already, then rows beside the row that keeps a folder empty.
    table.replace_own_days(bars(spark, bar("Z", "2023-12-29")))
    table.replace_date(bars(spark, bar("Z", "2024-01-30", 3.0)), d("2024-01-30"))
    assert table.extent(spark).count() == 2
    table.append(bars(spark, *[bar(f"S{n}", "2023-12-28") for n in range(200)]))
    assert rows(table.read(spark, "2024-01-01"), "symbol", "close_price") == [("Z", 3)]
    months = table.extent(spark).filter("month = 12 AND n_rows > 1").agg({"last_day": "min", "n_rows": "sum"})
    assert rows(months) and rows(table.last_day(spark)) == [(d("2024-01-30"),)]
    assert table.read(spark, end="2023-12-31").count() == 201


def test_stored_replace_own_days(spark, rows, table, stored):
    table.truncate_load(stored)
    table.replace_own_days(bars(spark, bar("Q", "2023-12-29", 7.0), bar("Q", "2024-01-29", 6.0)))
    assert rows(table.read(spark), *KEY) == [
        ("A", d("2024-01-30")),
        ("B", d("2024-01-30")),
        ("Q", d("2023-12-29")),
        ("Q", d("2024-01-29")),
    ]


def test_stored_replace_symbols(spark, rows, table, stored):
    table.truncate_load(stored)
    for _ in range(2):
        table.replace_symbols(bars(spark, bar("A", "2024-01-30", 9.0), bar("C", "2024-01-29", 8.0)))
        assert rows(table.read(spark), *KEY, "close_price") == [
            ("A", d("2023-12-29"), 1),
            ("A", d("2024-01-30"), 9),
            ("B", d("2024-01-30"), 4),
            ("C", d("2024-01-29"), 8),
        ]
    table.replace_symbols(stored.filter("false"))
    assert table.read(spark).count() == 4


def test_stored_upsert_and_append(spark, rows, table, stored):
    table.truncate_load(stored)
    for _ in range(2):
        table.upsert(bars(spark, bar("B", "2024-01-30", 9.0), bar("B", "2024-02-01", 1.0)))
        assert table.read(spark).count() == 6
    assert rows(table.read(spark, symbols=["B"]), "trading_date", "close_price") == [
        (d("2024-01-30"), 9),
        (d("2024-02-01"), 1),
    ]
    table.append(stored.limit(1))
    assert table.read(spark).count() == 7


def test_stored_copy_raw(spark, rows, table, stored, tmp_path):
    adjusted = BarTable(str(tmp_path / "adj"), adjusted=True, buckets=3)
    table.truncate_load(stored)
    adjusted.truncate_load(bars(spark, bar("B", "2024-01-30", 1.5), bar("X", "2024-01-30", 1.5), bar("A", "2024-01-29", 1.5)))
    excluded = spark.createDataFrame([("B",)], "symbol string")
    for _ in range(2):
        adjusted.copy_raw(table, [d("2024-01-30")], excluded)
        got = [(s, day, float(p)) for s, day, p in rows(adjusted.read(spark), *KEY, "close_price")]
        assert got == [("A", d("2024-01-29"), 1.5), ("A", d("2024-01-30"), 3.0), ("B", d("2024-01-30"), 1.5)]


def test_read_prunes_folders_and_rows(spark, table, stored):
    table.truncate_load(stored)
    df = table.read(spark, date(2024, 1, 1), date(2024, 1, 31), ["A"])
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters") :]
    folders, pushed = scan.split("PushedFilters")[:2]
    assert "year" in folders and "month" in folders and "bucket" in folders
    assert "trading_date" in pushed and "symbol" in pushed


def test_symbol_history_replaces_only_its_symbols(spark, rows, tmp_path):
    path = str(tmp_path / "reloaded")
    assert read_symbol_history(spark, path).count() == 0
    names = [f"S{n}" for n in range(6)]
    sink_symbol_history(bars(spark, *[bar(s, "2024-01-29") for s in names]), path, buckets=2)
    for _ in range(2):
        sink_symbol_history(bars(spark, bar("S1", "2024-01-30"), bar("S1", "2024-01-31")), path, buckets=2)
        got = rows(read_symbol_history(spark, path), *KEY)
        assert got == sorted(
            [(s, d("2024-01-29")) for s in names if s != "S1"] + [("S1", d("2024-01-30")), ("S1", d("2024-01-31"))]
        )
    assert read_symbol_history(spark, path, ["S1", "S2"]).count() == 3
    sink_symbol_history(bars(spark, bar("S1", "2024-01-30")).filter("false"), path)
    with pytest.raises(ValueError, match="is stored as"):
        sink_symbol_history(bars(spark, bar("S1", "2024-01-30")), path, buckets=3)
    assert read_symbol_history(spark, path).count() == 7
