from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.functions import dates, prices, text
from barloom.operators.units import benchmark_tickers
from tests.helpers import d


def values(spark, kind, inputs, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_symbols_are_stripped_of_all_whitespace(spark):
    got = values(spark, "string", [" fpt ", "\tHPG\n", " vnm　", "", None], text.normalize_symbol)
    assert got == ["FPT", "HPG", "VNM", "", None]


def test_exchange_labels_and_their_order(spark):
    codes = ["HSX", " hose ", "data.HNX.csv", "upcom", "HNX-UPCOM", "UPCOM-HOSE", "other", "", None]
    got = values(spark, "string", codes, text.normalize_exchange)
    assert got == ["HoSE", "HoSE", "HNX", "UPCoM", "UPCoM", "HoSE", "Unknown", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    "ticker, organ, symbol",
    [
        (" fpt", "X", "FPT"),
        ("nan", " hpg ", "HPG"),
        ("None", "HPG", "HPG"),
        ("<NA>", None, ""),
        ("", "VIC", "VIC"),
        (None, "vic", "VIC"),
        (None, None, ""),
    ],
)
def test_event_symbol(spark, ticker, organ, symbol):
    df = spark.createDataFrame([(ticker, organ)], "t string, o string")
    assert df.select(text.event_symbol(F.col("t"), F.col("o"))).first()[0] == symbol


def test_trading_date_is_lenient(spark):
    got = values(spark, "string", ["20240102", "20240231", "2024xx01", "", None], dates.parse_trading_date)
    assert got == [d("2024-01-02"), None, None, None, None]


def test_event_date_takes_the_first_ten_characters(spark):
    got = values(spark, "string", ["2024-01-02T09:00:00", "2024-01-02", "02/01/2024", None], dates.event_date)
    assert got == [d("2024-01-02"), d("2024-01-02"), None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_market_date_does_not_depend_on_the_session_zone(spark, zone):
    last = int(datetime.fromisoformat("2024-01-01T16:59:59.999+00:00").timestamp() * 1000)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, "bigint", [last, last + 1, None], dates.epoch_ms_to_market_date)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [d("2024-01-01"), d("2024-01-02"), None]


@pytest.mark.parametrize(
    "day, moment, closed",
    [
        ("2024-01-29", "2024-01-30T09:00:00", True),
        ("2024-01-30", "2024-01-30T16:29:59", False),
        ("2024-01-30", "2024-01-30T16:30:00", True),
        ("2024-01-30", "2024-01-30T17:00:00", True),
        ("2024-01-31", "2024-01-30T10:00:00", False),
    ],
)
def test_eod(spark, day, moment, closed):
    at = dates.moment(datetime.fromisoformat(moment))
    assert spark.range(1).select(dates.is_eod(F.lit(d(day)), at)).first()[0] is closed


@pytest.mark.parametrize(
    "last, eod, decision",
    [
        (None, None, "run"),
        ("2024-01-31", True, "stop_older"),
        ("2024-01-30", True, "stop_done"),
        ("2024-01-30", False, "rerun"),
        ("2024-01-30", None, "rerun"),
        ("2024-01-29", True, "run"),
        ("yesterday", True, "run"),
    ],
)
def test_run_decision(spark, last, eod, decision):
    df = spark.createDataFrame([(last, eod)], "l string, e boolean")
    got = dates.run_decision(F.lit(d("2024-01-30")), dates.parse_run_date(F.col("l")), F.col("e"))
    assert df.select(got).first()[0] == decision


def test_days_between_runs(spark):
    df = spark.createDataFrame(
        [(d("2024-01-26"), True), (d("2024-01-26"), False), (d("2024-01-29"), True), (d("2024-02-05"), True), (None, True)],
        "last date, eod boolean",
    )
    got = [r[0] for r in df.select(dates.days_between_runs(F.col("last"), F.col("eod"), F.lit(d("2024-01-30")))).collect()]
    days = [date(2024, 1, n) for n in range(26, 30)]
    assert got == [days[1:], days, None, None, None]


def test_volume_is_exact_and_lenient(spark):
    got = values(spark, "string", ["16777217", "100.0", "99.9", "1E+2", "x", "", None, "-1"], prices.to_volume)
    assert got == [16777217, 100, 99, 100, None, None, None, -1]


def test_unit_factor(spark):
    got = values(spark, "double", [999.99, 1000.0, 0.0, -1.0, float("nan"), float("inf"), None], prices.unit_factor)
    assert got == [1000.0, 1.0, None, None, None, None, None]


def test_rounding_is_half_up(spark):
    assert values(spark, "double", [0.5, 1.5, 2.4], prices.raw_price) == [1, 2, 2]
    assert [str(v) for v in values(spark, "double", [0.125, 1.005], prices.adjusted_price)] == ["0.13", "1.01"]


def test_benchmark_tickers():
    assert benchmark_tickers(" fpt, hpg ,x") == ["FPT", "HPG"]
    assert benchmark_tickers([]) == ["FPT", "HPG", "VNM", "VIC"]
    assert benchmark_tickers(None) == ["FPT", "HPG", "VNM", "VIC"]


def test_shown_symbols(spark):
    df = spark.createDataFrame([(["A", "B"], 2), (["A", "B"], 5), ([], 0)], "s array<string>, n bigint")
    got = [r[0] for r in df.select(text.shown_symbols(F.col("s"), F.col("n"), 2)).collect()]
    assert got == ["A, B", "A, B (+3 mã khác)", "Không có"]
