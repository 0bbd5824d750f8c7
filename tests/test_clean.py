import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.functions.prices import invalid_bar
from barloom.operators import clean, contract, snapshot
from barloom.operators.keyed import last_by
from barloom.schema import BAR_COLS, BOARD_SCHEMA, HISTORY_LINE_SCHEMA, KEY
from tests.helpers import bar, bars, d

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "o, h, l, c, volume, kept",
    [
        (10.0, 12.0, 9.0, 11.0, 0, True),
        (10.0, 10.0, 10.0, 10.0, 5, True),
        (10.0, 8.0, 9.0, 8.0, 1, False),
        (10.0, 9.5, 9.0, 9.2, 1, False),
        (10.0, 11.0, 9.0, 11.5, 1, False),
        (10.0, 12.0, 10.5, 11.0, 1, False),
        (10.0, 12.0, 9.5, 9.0, 1, False),
        (0.0, 12.0, 0.0, 11.0, 1, False),
        (10.0, 12.0, -1.0, 11.0, 1, False),
        (10.0, 12.0, 9.0, 11.0, -1, False),
        (10.0, 12.0, 9.0, 11.0, None, False),
    ],
)
def test_valid_bars(spark, o, h, l, c, volume, kept):
    df = bars(spark, bar("FPT", "2024-01-02", (o, h, l, c), volume))
    assert clean.valid_bars(df).count() == int(kept)


def test_unknown_volume_leaves_the_mask_undecided(spark):
    df = bars(spark, bar("FPT", "2024-01-02", 10.0, None))
    assert df.select(invalid_bar()).first()[0] is None


def test_sanitize_drops_null_nan_and_infinite_prices(spark):
    rows = [bar("A", "2024-01-02", (10.0, 10.0, 10.0, v)) for v in (10.0, None, NAN, INF, -INF)]
    assert clean.sanitize_prices(bars(spark, *rows)).count() == 1


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), HISTORY_LINE_SCHEMA).withColumn("exchange", F.lit("HNX"))


def test_clean_history(spark, rows):
    raw = lines(
        spark,
        (" fpt ", "20240102", 10.0, 12.5, 9.123456, 11.0, "16777217"),
        ("HPG", "20240231", 10.0, 12.0, 9.0, 11.0, "1"),
        (None, "20240102", 10.0, 12.0, 9.0, 11.0, "1"),
        ("BAD", "20240102", 10.0, 12.0, 9.0, 11.0, "1"),
        ("VIC", "20240102", 10.0, 12.0, 9.0, NAN, "1"),
        ("VNM", "20240102", 10.0, 12.0, 9.0, 11.0, None),
        ("SSI", "20240102", 0.000001, 12.0, 0.000001, 11.0, "1"),
    )
    blacklist = spark.createDataFrame([("BAD",), (None,)], "symbol string")
    got = rows(clean.clean_history(raw, "archive", blacklist))
    assert got == [("FPT", d("2024-01-02"), 10000.0, 12500.0, 9123.46, 11000.0, 16777217, "HNX", "archive")]


def board(spark, *rows):
    return spark.createDataFrame(list(rows), BOARD_SCHEMA)


def test_clean_board_and_reference(spark, rows):
    quote = ("fpt", "HSX", 1704128400000, 10.0, 12.0, 9.0, 11.0, 10.5, 10.7, 500)
    later = ("FPT ", "hose", 1704128401000, 10.0, 13.0, 9.0, 12.0, 10.5, 11.1, 700)
    stale = ("HPG", None, 1704128399999, 10.0, 12.0, 9.0, 11.0, None, None, 1)
    broken = ("VIC", "HNX", None, 10.0, 12.0, 9.0, 11.0, 1.0, 1.0, 1)
    cleaned = clean.clean_board(board(spark, quote, later, stale, broken), "VCI")
    assert rows(cleaned, "symbol", "trading_date", "exchange", "source", "total_volume") == [
        ("FPT", d("2024-01-02"), "HoSE", "vci", 500),
        ("FPT", d("2024-01-02"), "HoSE", "vci", 700),
        ("HPG", d("2024-01-01"), "Unknown", "vci", 1),
    ]
    one = clean.dedup_bars(cleaned, F.col("time"))
    joined = clean.reattach_reference(one.select(*BAR_COLS), cleaned, F.col("time"))
    assert rows(joined, "symbol", "reference_price", "average_price") == [
        ("FPT", 10.5, 11.1),
        ("HPG", None, None),
    ]


def test_multiplier_skips_missing_columns(spark, rows):
    df = clean.apply_multiplier(bars(spark, bar("A", "2024-01-02", 2.5)), 1000.0, ["reference_price"])
    assert rows(df, "close_price") == [(2500.0,)]


def test_attach_exchange(spark, rows):
    listing = spark.createDataFrame([("A", " hose "), ("B", None)], "symbol string, exchange string")
    df = bars(spark, bar("A", "2024-01-02"), bar("B", "2024-01-02"), bar("C", "2024-01-02"))
    got = rows(clean.attach_exchange(df, listing), "symbol", "exchange")
    assert got == [("A", "HoSE"), ("B", "Unknown"), ("C", "Unknown")]


def test_encodings(spark):
    df = bars(spark, bar("A", "2024-01-02", (1.5, 2.005, 1.0, 1.239)))
    raw, adj = clean.encode_raw(df).first(), clean.encode_adjusted(df).first()
    assert (raw.open_price, raw.high_price) == (2, 2)
    assert [str(adj[c]) for c in ("open_price", "high_price", "close_price")] == ["1.50", "2.01", "1.24"]


def test_last_row_does_not_depend_on_input_order(spark, rows):
    data = [bar("A" if i % 3 else "HOT", f"2024-01-{1 + i % 5:02d}", 10.0 + i, i) for i in range(200)]
    df = bars(spark, *data).withColumn("seq", F.col("total_volume"))
    want = {}
    for r in sorted(data, key=lambda r: r[6]):
        want[r[0], r[1]] = r[6]
    expected = sorted((s, day, v) for (s, day), v in want.items())
    for arranged in (df, df.orderBy(F.desc("seq")), df.repartition(7)):
        got = rows(clean.dedup_bars(arranged, F.col("seq")), *KEY, "total_volume")
        assert got == expected


def test_last_by_keeps_nulls_of_the_last_row(spark, rows):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, None)], "k string, n int, v string")
    assert rows(last_by(df, ["k"], F.col("n"))) == [("A", 2, None)]


def test_latest_per_symbol(spark, rows):
    df = bars(spark, bar("A", "2024-01-02"), bar("A", "2024-01-05"), bar("B", "2024-01-03"))
    got = rows(snapshot.latest_per_symbol(df), *KEY)
    assert got == [("A", d("2024-01-05")), ("B", d("2024-01-03"))]


def test_union_diagonal(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([(2, 7)], "i bigint, b int")
    got = rows(clean.union_diagonal(a, b), "i", "a", "b")
    assert got == [(1, "x", None), (2, None, 7)]


def test_contract(spark, rows):
    df = bars(
        spark,
        bar("FPT", "2024-01-02"),
        bar("a", "2024-01-02"),
        bar("HPG", "2024-01-02", (10.0, 9.0, 9.5, 9.0), None),
        bar("VIC", "2024-01-02", (10.0, 12.0, 10.5, 10.2)),
    )
    report = dict(rows(contract.contract_report(df)))
    found = {k: v for k, v in report.items() if v}
    assert found == {
        "symbol_format": 1,
        "total_volume_not_negative": 1,
        "high_ge_low": 1,
        "high_ge_open": 1,
        "low_le_close": 2,
        "low_le_open": 1,
    }
    broken = rows(contract.contract_rows(df), "symbol", "broken_rules")
    assert broken == [
        ("HPG", "total_volume_not_negative,high_ge_low,high_ge_open"),
        ("a", "symbol_format"),
    ]


def test_enforced_contract_fails_the_job(spark):
    good = bars(spark, bar("FPT", "2024-01-02"))
    assert contract.enforce_contract(good).count() == 1
    with pytest.raises(PySparkException, match="data contract broken by a on 2024-01-02"):
        contract.enforce_contract(bars(spark, bar("a", "2024-01-02"))).count()
