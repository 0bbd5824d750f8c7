"""Every registered query against its SQL text, and the shape of the plans."""

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: build for name, build in spark_entry.queries().items() if name in spark_entry.QUERIES}
TEXTS = spark_entry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_text():
    assert set(QUERIES) == set(TEXTS)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and "symbol" in df.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, FOLDER), con, TEXTS[name])
    assert found == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that land files first would only show the plan of the read.
LAZY = [
    "valid_bars",
    "blacklist_filter",
    "contract_report",
    "clean_board",
    "reattach_reference",
    "attach_exchange",
    "latest_per_symbol",
    "dedup_bars",
    "dedup_history",
    "history_topk",
    "source_fallback",
    "event_date_per_symbol",
    "unit_vote",
    "gap_fill_t0",
    "replace_date",
    "replace_symbols",
    "copy_raw_to_adj",
    "upsert_bars",
    "eod_snapshot",
    "missing_days",
    "reload_set",
    "reload_outcome",
    "corporate_actions",
]


@pytest.mark.parametrize("name", LAZY)
def test_plan_stays_in_the_jvm_without_products(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("Python", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


@pytest.mark.parametrize("name", ["history_topk", "report_symbols"])
def test_ranking_is_trimmed_before_the_shuffle(spark, name):
    assert plan_of(QUERIES[name](spark, FOLDER)).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["dedup_bars", "latest_per_symbol", "eod_snapshot"])
def test_last_row_is_reduced_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "partial_max(" in plan and "Window" not in plan


def test_costly_columns_are_computed_once(spark):
    """The rounding of a price is not repeated in the filters above it."""
    plan = plan_of(QUERIES["dedup_bars"](spark, FOLDER))
    assert plan.count("round(") <= 4 * 2


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = plan_of(QUERIES["missing_days"](spark, FOLDER))
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "value" not in schema and "props" not in schema
