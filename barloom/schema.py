"""Declared schemas and the fixed values every module shares.

Readers always get an explicit schema; nothing is inferred from data.
"""

from pyspark.sql import types as T

PRICE_COLS = ["open_price", "high_price", "low_price", "close_price"]
KEY = ["symbol", "trading_date"]
BAR_COLS = KEY + PRICE_COLS + ["total_volume", "exchange", "source"]
BOARD_EXTRA_COLS = ["reference_price", "average_price"]
SNAPSHOT_COLS = ["symbol", "exchange", "trading_date"] + PRICE_COLS + ["average_price", "total_volume"]
EVENT_COLS = ["symbol", "event_type", "ex_date", "record_date", "ratio"]

# They must equal the market's conventions for right results.
SYMBOL_PATTERN = "^[A-Z0-9_-]{3,12}$"
TICKER_PATTERN = "^[A-Z0-9]{3,10}$"
MISSING_TICKERS = ["", "NAN", "NONE", "<NA>"]
EXCLUDED_TYPES = ["corpbond", "bond", "future"]
EVENT_CODES = ["DIV", "ISS"]
DEFAULT_EVENT_CODE = "DIV"
DEFAULT_BENCHMARKS = ["FPT", "HPG", "VNM", "VIC"]
FALLBACK_SOURCES = ["vci", "kbs", "msn"]
MARKET_ZONE = "Asia/Ho_Chi_Minh"
HISTORY_START = "2000-01-01"
PRICE_FACTOR = 1000
UNIT_THRESHOLD = 1000.0
DEFAULT_BOARD_MULTIPLIER = 1.0
DEFAULT_HISTORY_MULTIPLIER = 1000.0
EOD_HOUR, EOD_MINUTE = 16, 30
MOST_ABSENT_SHARE = 0.5
MOST_BROKEN_SHARE = 0.01
REPORT_SHOWN = 15
REPORT_NONE = "Không có"
REPORT_MORE = " (+{} mã khác)"
STATUS_OK, STATUS_WARN = "✅", "⚠️"
ZIP_SIGNATURE = b"PK\x03\x04"

PRICE_ADJ = T.DecimalType(18, 2)


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _bars(price):
    return _struct(
        ("symbol", T.StringType()),
        ("trading_date", T.DateType()),
        *[(c, price) for c in PRICE_COLS],
        ("total_volume", T.LongType()),
        ("exchange", T.StringType()),
        ("source", T.StringType()),
    )


BAR_SCHEMA = _bars(T.DoubleType())
RAW_SCHEMA = _bars(T.LongType())
ADJ_SCHEMA = _bars(PRICE_ADJ)

# Volume stays text until it is cast: feeds write it as 100, 100.0 or 1E+2.
HISTORY_LINE_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("trading_date", T.StringType()),
    *[(c, T.DoubleType()) for c in PRICE_COLS],
    ("total_volume", T.StringType()),
)

HISTORY_LINE_DDL = ddl(HISTORY_LINE_SCHEMA)

BOARD_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("exchange", T.StringType()),
    ("time", T.LongType()),
    *[(c, T.DoubleType()) for c in PRICE_COLS + BOARD_EXTRA_COLS],
    ("volume_accumulated", T.LongType()),
)

HISTORY_FEED_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("source", T.StringType()),
    ("time", T.DateType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.LongType()),
)

EVENT_SCHEMA = _struct(
    ("exrightDate", T.StringType()),
    ("recordDate", T.StringType()),
    ("ticker", T.StringType()),
    ("organCode", T.StringType()),
    ("eventCode", T.StringType()),
    ("exerciseRatio", T.StringType()),
)
EVENT_PAGE_SCHEMA = _struct(("data", _struct(("content", T.ArrayType(EVENT_SCHEMA)))))

LISTING_SCHEMA = _struct(
    ("symbol", T.StringType()), ("exchange", T.StringType()), ("type", T.StringType())
)

SNAPSHOT_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("exchange", T.StringType()),
    ("trading_date", T.DateType()),
    *[(c, T.LongType()) for c in PRICE_COLS],
    ("average_price", T.DoubleType()),
    ("total_volume", T.LongType()),
)

RUN_STATE_SCHEMA = _struct(
    ("last_successful_run", T.StringType()),
    ("is_eod", T.BooleanType()),
    ("total_tickers", T.LongType()),
)
PENDING_SCHEMA = _struct(("symbol", T.StringType()))
STATE_SCHEMA = _struct(("key", T.StringType()), ("value", T.StringType()))
