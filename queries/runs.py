"""Calendar, run state, corporate actions and the adjusted history."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from barloom.functions import dates
from barloom.operators import adjust, calendar, clean, events, report, snapshot, symbols
from barloom.operators.keyed import landed, last_by
from barloom.plans.daily import DailyFeeds, DailySettings, run_daily
from barloom.schema import BAR_COLS, PRICE_ADJ, PRICE_COLS
from barloom.sinks.bar_table import BarTable, read_symbol_history
from barloom.sinks.history_feed import BucketedHistory
from barloom.sinks.run_state import RunState, version_of
from queries.cleaning import board_bars, cleaned
from queries.feeds import AS_OF, BEFORE_CLOSE, INVALID, TODAY, exchange_label
from queries.registry import query

_ORDER_DAYS = "SELECT DISTINCT cast(o_orderdate AS date) AS trading_date FROM orders"


def _order_days(t):
    day = F.col("o_orderdate").cast("date").alias("trading_date")
    return t.table("orders").select(day).distinct()


@query(
    "trading_days",
    ["holidays"],
    f"""SELECT trading_date FROM ({_ORDER_DAYS}) WHERE dayofweek(trading_date) BETWEEN 1 AND 5
  AND trading_date NOT IN (SELECT holiday FROM holidays)""",
)
def _(t):
    return calendar.trading_days(_order_days(t), t.holidays)


@query(
    "run_gate",
    ["holidays"],
    f"""SELECT trading_date, CASE WHEN dayofweek(trading_date) IN (0, 6) THEN 'skip_weekend'
       WHEN trading_date IN (SELECT holiday FROM holidays) THEN 'skip_holiday' ELSE 'run' END AS gate
FROM ({_ORDER_DAYS})""",
)
def _(t):
    return calendar.run_gate(_order_days(t), t.holidays)


# An entry text per order: a date with slashes, one with hyphens, and no date.
_ENTRIES = """SELECT strftime(o_orderdate, '%Y/%m/%d') || ', ' ||
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || ',' || o_orderpriority AS entries FROM orders"""
_CUSTOM = """SELECT DISTINCT cast(o_orderdate AS date) AS holiday FROM orders
UNION SELECT cast(o_orderdate AS date) + 1 FROM orders"""


def _custom(t):
    day = F.col("o_orderdate").cast("date")
    entries = F.concat(
        F.date_format(day, "yyyy/MM/dd"),
        F.lit(", "),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd"),
        F.lit(","),
        F.col("o_orderpriority"),
    )
    return calendar.custom_holidays(t.table("orders").select(entries.alias("entries")))


@query("custom_holidays", [], _CUSTOM)
def _(t):
    return _custom(t)


@query("holiday_calendar", ["holidays"], f"SELECT holiday FROM holidays UNION ({_CUSTOM})")
def _(t):
    return calendar.holiday_calendar(t.holidays, _custom(t))


@query(
    "eod_flag",
    [],
    """SELECT event_id, cast(ts AS date) < DATE '2024-01-30'
       OR hour(ts) * 60 + minute(ts) >= 990 AS is_eod FROM events""",
)
def _(t):
    """Each event's day, seen on the last day at the event's time of day."""
    last_day = F.make_dt_interval(F.datediff(F.lit(TODAY), F.col("ts").cast("date")))
    flag = dates.is_eod(F.col("ts").cast("date"), F.col("ts") + last_day)
    return t.table("events").select("event_id", flag.alias("is_eod"))


_DECISION = """CASE WHEN last_run IS NULL THEN 'run' WHEN t0_max < last_run THEN 'stop_older'
       WHEN t0_max = last_run AND is_eod THEN 'stop_done' WHEN t0_max = last_run THEN 'rerun'
       ELSE 'run' END"""


@query(
    "run_decision",
    ["state_dates"],
    f"SELECT symbol, event_type, {_DECISION} AS decision FROM state_dates",
)
def _(t):
    return calendar.run_decisions(t.states).select("symbol", "event_type", "decision")


@query(
    "missing_days",
    ["state_dates", "holidays"],
    """SELECT symbol, event_type, trading_date FROM (
  SELECT symbol, event_type,
         cast(unnest(generate_series(last_run + (CASE WHEN is_eod THEN 1 ELSE 0 END),
                                     t0_max - 1, INTERVAL 1 DAY)) AS date) AS trading_date
  FROM state_dates WHERE last_run IS NOT NULL)
WHERE dayofweek(trading_date) BETWEEN 1 AND 5 AND trading_date NOT IN (SELECT holiday FROM holidays)""",
)
def _(t):
    return calendar.missing_days(t.states, t.holidays)


_SNAP = """symbol, exchange, trading_date, {prices},
       round({average}, 1) AS average_price, total_volume"""


def _snap(average):
    return _SNAP.format(
        prices=", ".join(f"cast(round({c}) AS bigint) AS {c}" for c in PRICE_COLS), average=average
    )


_MEAN = "(open_price + high_price + low_price + close_price) / 4.0"
_OLD = f"""old AS (SELECT {_snap("close_price")} FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY total_volume DESC, trading_date DESC) = 1)"""
_NEW = f"""new AS (SELECT {_snap(_MEAN)} FROM cleaned WHERE symbol <> ''
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC, seq DESC) = 1)"""


def _old_snapshot(t):
    """An earlier snapshot: per symbol its busiest day."""
    rows = t.bars.withColumn("average_price", F.col("close_price"))
    rows = last_by(rows, ["symbol"], F.col("total_volume"), F.col("trading_date"))
    return snapshot.round_snapshot(rows)


def _deduped(t):
    return clean.dedup_bars(cleaned(t), F.col("seq")).drop("seq")


@query(
    "eod_snapshot",
    ["bars", "cleaned", "active"],
    f""", {_OLD}, {_NEW}
SELECT * FROM (SELECT *, 0 AS p FROM old UNION ALL SELECT *, 1 FROM new)
WHERE symbol IN (SELECT symbol FROM active)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC, p DESC) = 1""".replace(
        "SELECT * FROM (SELECT *, 0", "SELECT * EXCLUDE (p) FROM (SELECT *, 0"
    ),
)
def _(t):
    return snapshot.eod_snapshot(
        _deduped(t), _old_snapshot(t), dates.moment(AS_OF), symbols.active_symbols(t.listing)
    )


@query("eod_snapshot_open", ["bars"], f", {_OLD} SELECT * FROM old")
def _(t):
    """Before the close of the last day the old snapshot stays as it is."""
    return snapshot.eod_snapshot(_deduped(t), _old_snapshot(t), dates.moment(BEFORE_CLOSE))


@query(
    "run_metadata",
    ["bars", "cleaned"],
    f""", {_OLD}, {_NEW}
SELECT strftime(max(trading_date), '%Y-%m-%d') AS last_successful_run, true AS is_eod,
       (SELECT count(DISTINCT symbol) FROM (SELECT symbol FROM old UNION SELECT symbol FROM new))
         AS total_tickers FROM cleaned""",
)
def _(t):
    bars = _deduped(t)
    new = snapshot.eod_snapshot(bars, _old_snapshot(t), dates.moment(AS_OF))
    return snapshot.run_metadata(bars, new, dates.moment(AS_OF))


_ACTIONS = """SELECT * FROM event_rows WHERE ex_date BETWEEN DATE '{}' AND DATE '{}'
  AND regexp_matches(symbol, '^[A-Z0-9]{{3,10}}$')"""


@query(
    "corporate_actions",
    ["event_rows", "active"],
    _ACTIONS.format("1996-03-01", "1999-09-30") + " AND symbol IN (SELECT symbol FROM active)",
)
def _(t):
    listed = symbols.active_symbols(t.listing)
    return events.corporate_actions(t.events, "1996-03-01", "1999-09-30", listed)


_LAST_ORDER_DAY = date(2001, 8, 1)
_RELOAD = f""", today_events AS ({_ACTIONS.format("2001-08-01", "2001-08-01")}),
late_events AS ({_ACTIONS.format("2001-07-01", "2001-07-31")}),
pending AS (SELECT DISTINCT symbol FROM blacklist),
ranked AS (SELECT symbol, max(ex_date) AS ex_date, 0 AS p FROM today_events GROUP BY symbol
  UNION ALL SELECT symbol, max(ex_date), 1 FROM late_events GROUP BY symbol
  UNION ALL SELECT symbol, DATE '2001-08-01', 2 FROM pending),
reload AS (SELECT symbol, ex_date FROM ranked
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY p DESC) = 1)
"""


def _reload_set(t):
    on_day = events.corporate_actions(t.events, _LAST_ORDER_DAY, _LAST_ORDER_DAY)
    late = events.corporate_actions(t.events, date(2001, 7, 1), date(2001, 7, 31))
    # Pending symbols come as they were stored, also entries that are no ticker.
    pending = t.blacklist_lines.select(F.col("value").alias("symbol"))
    pending = pending.filter(~F.col("symbol").contains("#"))
    return events.reload_set(on_day, late, pending, _LAST_ORDER_DAY)


@query("reload_set", ["event_rows", "blacklist"], _RELOAD + "SELECT * FROM reload")
def _(t):
    return _reload_set(t)


# A reload per symbol with a download; it works unless its newest order came from the last source.
_RELOADED = """wanted AS (SELECT DISTINCT symbol FROM downloads),
outcome AS (SELECT symbol, CASE WHEN max_by(source, seq) <> 'MSN' THEN 'ok' ELSE 'failed' END AS status
  FROM downloads GROUP BY symbol)
"""


def _outcome(t):
    worked = t.downloads.groupBy("symbol").agg(F.max_by("source", "seq").alias("source"))
    return adjust.reload_outcome(t.downloads.select("symbol"), worked.filter(F.col("source") != "MSN"))


@query("reload_outcome", ["downloads"], f", {_RELOADED} SELECT * FROM outcome")
def _(t):
    return _outcome(t)


@query("pending_after", ["downloads"], f", {_RELOADED} SELECT symbol FROM outcome WHERE status <> 'ok'")
def _(t):
    return events.pending_after(_outcome(t))


def _sql_text(where):
    return f"""(SELECT CASE WHEN count(*) = 0 THEN 'Không có' ELSE
  string_agg(symbol, ', ' ORDER BY symbol) FILTER (WHERE r <= 15) ||
  CASE WHEN count(*) > 15 THEN ' (+' || cast(count(*) - 15 AS varchar) || ' mã khác)' ELSE '' END END
  FROM (SELECT symbol, row_number() OVER (ORDER BY symbol) AS r FROM outcome WHERE {where}))"""


@query(
    "run_report",
    ["downloads", "board_bars", "state_dates", "holidays"],
    f""", {_RELOADED}
SELECT max(trading_date) AS trading_date, count(*) AS rows_loaded, 0::BIGINT AS absent_symbols, true AS is_eod,
  (SELECT string_agg(strftime(d, '%Y-%m-%d'), ', ' ORDER BY d) FROM (
     SELECT DISTINCT cast(ts AS date) AS d FROM events) WHERE dayofweek(d) BETWEEN 1 AND 5
     AND d NOT IN (SELECT holiday FROM holidays)) AS missing_dates,
  'Không có' AS unfilled_dates, {_sql_text("status = 'ok'")} AS reloaded,
  {_sql_text("status <> 'ok'")} AS failed, '⚠️' AS status
FROM board_bars""",
)
def _(t):
    days = t.table("events").select(F.col("ts").cast("date").alias("trading_date")).distinct()
    missing = calendar.trading_days(days, t.holidays)
    outcome = landed(_outcome(t))
    return report.run_report(board_bars(t), outcome, missing, dates.moment(AS_OF) + F.expr("INTERVAL 2 DAYS"))


_FILLED = f""", hist AS (SELECT symbol, trading_date, open_price, high_price, low_price, close_price,
    total_volume, exchange, source FROM bars WHERE total_volume > 1),
ends AS (SELECT symbol, max(trading_date) AS e FROM hist GROUP BY symbol),
latest AS (SELECT * FROM board_bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) = 1)
SELECT * FROM hist
UNION ALL SELECT symbol, DATE '{TODAY}', open_price, high_price, low_price, close_price,
  total_volume, exchange, source FROM latest JOIN ends USING (symbol) WHERE e < DATE '{TODAY}'"""


@query("gap_fill_t0", ["bars", "board_bars"], _FILLED)
def _(t):
    history = t.bars.filter(F.col("total_volume") > 1)
    return adjust.gap_fill(history, board_bars(t), TODAY)


_ADJUSTED = """adjusted AS (
  SELECT h.symbol, h.trading_date, h.open_price, h.high_price, h.low_price, h.close_price, h.total_volume,
         coalesce(CASE WHEN l.symbol IS NOT NULL THEN {label} END, 'Unknown') AS exchange, h.source
  FROM (SELECT * FROM (
          SELECT symbol, time AS trading_date, open * 1000.0::double AS open_price,
                 high * 1000.0::double AS high_price, low * 1000.0::double AS low_price,
                 close * 1000.0::double AS close_price, volume AS total_volume,
                 lower(source) AS source, seq
          FROM (SELECT *, CASE lower(source) WHEN 'vci' THEN 0 WHEN 'kbs' THEN 1 ELSE 2 END AS p
                FROM downloads WHERE time BETWEEN DATE '1996-01-01' AND DATE '2024-01-30'
                  AND symbol IN (SELECT symbol FROM wanted)
                QUALIFY min(p) OVER (PARTITION BY symbol) = p))
        WHERE NOT {invalid}
        QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY seq DESC) = 1) h
  LEFT JOIN listing l ON l.symbol = h.symbol),
board_latest AS (SELECT * FROM board_bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) = 1)
SELECT * FROM adjusted
UNION ALL SELECT b.symbol, DATE '{today}', b.open_price, b.high_price, b.low_price, b.close_price,
  b.total_volume, coalesce(CASE WHEN l.symbol IS NOT NULL THEN {label} END, 'Unknown'), b.source
FROM board_latest b LEFT JOIN listing l ON l.symbol = b.symbol
WHERE b.symbol IN (SELECT symbol FROM adjusted GROUP BY symbol HAVING max(trading_date) < DATE '{today}')
""".format(label=exchange_label("l.exchange"), invalid=INVALID, today=TODAY)


@query(
    "adjusted_history",
    ["downloads", "board_bars", "listing", "active"],
    f""", wanted AS (SELECT symbol FROM active), {_ADJUSTED}""",
)
def _(t):
    """Every active symbol's whole history rebuilt, and today's row."""
    return adjust.adjusted_history(
        t.downloads,
        board_bars(t).select(*BAR_COLS),
        t.listing,
        symbols.active_symbols(t.listing),
        TODAY,
        1000.0,
        adjust.source_order("VCI"),
        "1996-01-01",
        TODAY,
        order=("seq",),
    )


@query(
    "adjusted_history_bucketed",
    ["downloads", "board_bars", "listing", "active"],
    f""", wanted AS (SELECT symbol FROM active), {_ADJUSTED}""",
)
def _(t):
    """The same from a feed that lies in symbol buckets, landed in two batches."""
    feed = BucketedHistory(t.spark, t.scratch("feed"), 16, t.downloads.schema)
    old = F.col("time") < F.lit("2000-01-01").cast("date")
    feed.append(t.downloads.filter(old))
    feed.append(t.downloads.filter(~old | old.isNull()))
    return adjust.adjusted_history(
        feed,
        board_bars(t).select(*BAR_COLS),
        t.listing,
        symbols.active_symbols(t.listing),
        TODAY,
        1000.0,
        adjust.source_order("VCI"),
        "1996-01-01",
        TODAY,
        order=("seq",),
    )


@query(
    "absent_days",
    ["cleaned", "holidays"],
    f"""SELECT trading_date FROM ({_ORDER_DAYS} UNION SELECT DISTINCT trading_date FROM cleaned)
WHERE trading_date NOT IN (SELECT trading_date FROM cleaned)""",
)
def _(t):
    loaded = cleaned(t).select("trading_date")
    return calendar.absent_days(_order_days(t).unionByName(loaded.distinct()).distinct(), loaded)


# A whole daily run. Up to 25 January everything is loaded and closed; the 26th
# and 29th were missed. The board shows the 30th, the history feed ends on the 29th.
_LAST_LOADED = date(2024, 1, 25)


def _daily_events(t):
    """An event per listed symbol, its ex date by the balance of the customer."""
    balance = F.col("c_acctbal")
    day = (
        F.when(balance < 500, "2024-01-30")
        .when(balance < 800, "2024-01-26T00:00:00")
        .when(balance < 1000, "2024-01-28T00:00:00")
        .when(balance < 1200, "2024-01-29T00:00:00")
        .otherwise("2024-01-25")
    )
    symbol = F.concat(F.lit("S"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return t.table("customer").select(
        day.alias("exrightDate"),
        F.lit(None).cast("string").alias("recordDate"),
        symbol.alias("ticker"),
        symbol.alias("organCode"),
        F.lit("DIV").alias("eventCode"),
        F.lit(None).cast("string").alias("exerciseRatio"),
    )


def _daily(t):
    bars = landed(t.bars)
    raw = BarTable(t.scratch("raw"), buckets=2)
    adjusted = BarTable(t.scratch("adj"), adjusted=True, buckets=2)
    state = RunState(t.scratch("state"))
    before = bars.filter(F.col("trading_date") <= F.lit(_LAST_LOADED))
    raw.truncate_load(before)
    adjusted.truncate_load(before.withColumns({c: F.col(c) / 2 for c in PRICE_COLS}))
    earlier = AS_OF - timedelta(days=5)
    first = landed(snapshot.eod_snapshot(before, state.snapshot(t.spark), dates.moment(earlier)))
    meta = snapshot.run_metadata(before, first, dates.moment(earlier))
    state.save(meta, t.blacklist, first, version_of(earlier))

    # Symbols that did not trade on the day show their last one; nothing is later than the run.
    on_board = t.board.filter(dates.epoch_ms_to_market_date(F.col("time")) <= F.lit(TODAY))
    history = bars.filter(F.col("trading_date") < F.lit(TODAY)).select(
        "symbol",
        F.lit("VCI").alias("source"),
        F.col("trading_date").alias("time"),
        *[F.col(c).alias(c.removesuffix("_price")) for c in PRICE_COLS],
        F.col("total_volume").alias("volume"),
    )
    feeds = DailyFeeds(
        t.listing, landed(on_board), history, _daily_events(t), t.holidays, landed(t.day_archives())
    )
    voters = ("S00000003", "S00000007", "S00000011", "S00000013")
    settings = DailySettings(AS_OF, benchmarks=voters, most_absent=1.0)
    reloaded = t.scratch("reloaded")
    summary = run_daily(t.spark, feeds, raw, adjusted, state, reloaded, settings)
    return raw, adjusted, state, reloaded, summary


_DAILY_SQL = f"""
, t0 AS (SELECT symbol, trading_date,
    {", ".join(f"{c} * 1000 AS {c}" for c in [*PRICE_COLS, "average_price"])},
    total_volume, exchange, source FROM board_bars WHERE trading_date <= DATE '{TODAY}'),
filled AS (SELECT * EXCLUDE (seq) FROM cleaned
  WHERE trading_date IN (DATE '2024-01-26', DATE '2024-01-29')
  QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY seq DESC) = 1),
actions AS (SELECT {"'S' || lpad(cast(c_custkey AS varchar), 8, '0')"} AS symbol,
    CASE WHEN c_acctbal < 500 THEN DATE '2024-01-30' WHEN c_acctbal < 800 THEN DATE '2024-01-26'
         WHEN c_acctbal < 1000 THEN DATE '2024-01-28' WHEN c_acctbal < 1200 THEN DATE '2024-01-29'
         ELSE DATE '2024-01-25' END AS ex_date FROM customer),
reload AS (SELECT symbol FROM actions WHERE ex_date = DATE '2024-01-30' AND symbol IN (SELECT symbol FROM t0)
  UNION SELECT symbol FROM actions WHERE ex_date BETWEEN DATE '2024-01-26' AND DATE '2024-01-29'
    AND symbol IN (SELECT symbol FROM active)
  UNION SELECT symbol FROM blacklist),
week AS (SELECT max_by(close_price, trading_date) AS price FROM bars
  WHERE trading_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-29'
    AND symbol IN ('S00000003', 'S00000007', 'S00000011', 'S00000013')
    AND symbol IN (SELECT symbol FROM active) GROUP BY symbol),
factor AS (SELECT coalesce((SELECT m FROM (SELECT CASE WHEN price < 1000 THEN 1000.0 ELSE 1.0 END AS m
  FROM week WHERE price > 0) GROUP BY m ORDER BY count(*) DESC, m LIMIT 1), 1000.0)::double AS h),
hist AS (SELECT b.* REPLACE ({", ".join(f"{c} * h AS {c}" for c in PRICE_COLS)}, 'vci' AS source,
    coalesce(CASE WHEN l.symbol IS NOT NULL THEN {exchange_label("l.exchange")} END, 'Unknown') AS exchange)
  FROM bars b CROSS JOIN factor LEFT JOIN active l ON l.symbol = b.symbol
  WHERE trading_date < DATE '{TODAY}' AND b.symbol IN (SELECT symbol FROM reload)
    AND NOT {INVALID.replace("open_price", "b.open_price")}),
rebuilt AS (SELECT * FROM hist UNION ALL
  SELECT t.symbol, DATE '{TODAY}', t.open_price, t.high_price, t.low_price, t.close_price, t.total_volume,
    coalesce(CASE WHEN l.symbol IS NOT NULL THEN {exchange_label("l.exchange")} END, 'Unknown'), t.source
  FROM (SELECT * FROM t0 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) = 1) t
  LEFT JOIN active l ON l.symbol = t.symbol WHERE t.symbol IN (SELECT symbol FROM hist)),
outcome AS (SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM rebuilt) THEN 'ok' ELSE 'failed' END AS status
  FROM reload),
done AS (SELECT * FROM rebuilt),
raw_table AS (SELECT symbol, trading_date, {", ".join(f"cast(round({c}) AS bigint) AS {c}" for c in PRICE_COLS)},
    total_volume, exchange, source FROM (
  SELECT * FROM (SELECT * FROM bars WHERE trading_date <= DATE '{_LAST_LOADED}'
    UNION ALL SELECT symbol, trading_date, open_price, high_price, low_price, close_price,
      total_volume, exchange, source FROM filled)
    WHERE (symbol, trading_date) NOT IN (SELECT (symbol, trading_date) FROM t0)
  UNION ALL SELECT symbol, trading_date, open_price, high_price, low_price, close_price,
    total_volume, exchange, source FROM t0)),
adj_table AS (
  SELECT symbol, trading_date, {", ".join(f"cast(round({c} / 2, 2) AS decimal(18,2)) AS {c}" for c in PRICE_COLS)},
    total_volume, exchange, source FROM bars WHERE trading_date <= DATE '{_LAST_LOADED}'
    AND NOT (symbol IN (SELECT symbol FROM done) AND trading_date >= (SELECT min(trading_date) FROM done))
  UNION ALL SELECT symbol, trading_date, {", ".join(f"cast(round({c}, 2) AS decimal(18,2)) AS {c}" for c in PRICE_COLS)},
    total_volume, exchange, source FROM done
  UNION ALL SELECT symbol, trading_date, {", ".join(f"cast({c} AS decimal(18,2)) AS {c}" for c in PRICE_COLS)},
    total_volume, exchange, source FROM raw_table
    WHERE trading_date IN (DATE '2024-01-26', DATE '2024-01-29', DATE '{TODAY}')
    AND symbol NOT IN (SELECT symbol FROM reload))
"""
_DAILY_FEEDS = ["bars", "cleaned", "board_bars", "active", "blacklist"]


_WIDE = ", ".join(f"cast({c} AS decimal(18,2)) AS {c}" for c in PRICE_COLS)
_PAD = "NULL::date AS trading_date, " + ", ".join(f"NULL::decimal(18,2) AS {c}" for c in PRICE_COLS)


@query(
    "daily_update",
    _DAILY_FEEDS,
    _DAILY_SQL
    + f"""SELECT 'adjusted' AS part, symbol, trading_date, {_WIDE}, total_volume, exchange, source FROM adj_table
UNION ALL SELECT 'raw', symbol, trading_date, {_WIDE}, total_volume, exchange, source FROM raw_table
UNION ALL SELECT 'reloaded', symbol, trading_date, {", ".join(f"cast(round({c}, 2) AS decimal(18,2))" for c in PRICE_COLS)},
  total_volume, exchange, source FROM done
UNION ALL SELECT 'pending', symbol, {_PAD}, NULL, NULL, NULL FROM outcome WHERE status <> 'ok'""",
)
def _(t):
    """All that a daily run leaves behind: both tables, the reloaded histories, the pending symbols."""
    raw, adjusted, state, reloaded, _ = _daily(t)

    def part(df, name):
        return df.withColumn("part", F.lit(name)).withColumns(
            {c: F.col(c).cast(PRICE_ADJ) for c in PRICE_COLS if c in df.columns}
        )

    return clean.union_diagonal(
        part(adjusted.read(t.spark), "adjusted"),
        part(raw.read(t.spark), "raw"),
        part(read_symbol_history(t.spark, reloaded), "reloaded"),
        part(state.pending(t.spark), "pending"),
    )


@query(
    "daily_update_report",
    _DAILY_FEEDS,
    _DAILY_SQL
    + f"""SELECT DATE '{TODAY}' AS trading_date, (SELECT count(*) FROM t0) AS rows_loaded,
  (SELECT count(DISTINCT symbol) FROM active WHERE symbol NOT IN (SELECT symbol FROM t0)) AS absent_symbols, true AS is_eod,
  '2024-01-26, 2024-01-29' AS missing_dates, 'Không có' AS unfilled_dates,
  {_sql_text("status = 'ok'")} AS reloaded, {_sql_text("status <> 'ok'")} AS failed,
  CASE WHEN EXISTS (SELECT 1 FROM outcome WHERE status <> 'ok') THEN '⚠️' ELSE '✅' END AS status""",
)
def _(t):
    return _daily(t)[4]
