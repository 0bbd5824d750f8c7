"""Projections, filters, contract and de-duplication."""

from pyspark.sql import functions as F

from barloom.functions import dates, prices, text
from barloom.operators import adjust, clean, contract, events, report, snapshot, symbols, tables, units
from barloom.operators.columns import compute_once
from barloom.schema import DEFAULT_BENCHMARKS, KEY, PRICE_COLS
from queries.feeds import AS_OF, FINITE, INVALID, TODAY, exchange_label
from queries.registry import query

_PRICES = ", ".join(PRICE_COLS)


def typed(t):
    """Raw lines with types, before any row is dropped."""
    return compute_once(
        t.lines,
        {
            "symbol": text.normalize_symbol(F.col("symbol")),
            "trading_date": dates.parse_trading_date(F.col("trading_date")),
            "total_volume": prices.to_volume(F.col("total_volume")),
            "exchange": text.normalize_exchange(F.col("exchange")),
        },
    ).withColumn("source", F.lit("archive"))


def cleaned(t):
    return clean.clean_history(
        t.lines.withColumn("exchange", text.normalize_exchange(F.col("exchange"))), "archive"
    )


def board_clean(t):
    return clean.clean_board(t.board, "VCI")


def board_bars(t):
    return clean.dedup_bars(board_clean(t), F.col("time"), F.col("total_volume")).drop("time")


@query("normalize_symbol", ["lines"], "SELECT seq, upper(trim(symbol)) AS symbol FROM lines")
def _(t):
    return t.lines.select("seq", text.normalize_symbol(F.col("symbol")).alias("symbol"))


@query(
    "normalize_exchange",
    ["lines"],
    f"SELECT seq, {exchange_label('exchange')} AS exchange FROM lines",
)
def _(t):
    return t.lines.select("seq", text.normalize_exchange(F.col("exchange")).alias("exchange"))


@query("sanitize_prices", ["lines"], f"SELECT seq, {_PRICES} FROM lines WHERE {FINITE}")
def _(t):
    return clean.sanitize_prices(t.lines.select("seq", *PRICE_COLS))


@query(
    "scale_prices",
    ["typed"],
    f"""SELECT seq, {", ".join(f"round({c} * 1000, 2) AS {c}" for c in PRICE_COLS)}, total_volume
FROM typed WHERE {FINITE}""",
)
def _(t):
    sane = clean.sanitize_prices(typed(t).select("seq", *PRICE_COLS, "total_volume"))
    return clean.scale_prices(sane)


@query(
    "board_trading_date",
    ["board"],
    """SELECT upper(symbol) AS symbol, time,
       cast(make_timestamp(time * 1000) + INTERVAL 7 HOUR AS date) AS trading_date FROM board""",
)
def _(t):
    day = dates.epoch_ms_to_market_date(F.col("time")).alias("trading_date")
    return t.board.select(F.upper("symbol").alias("symbol"), "time", day)


@query(
    "parse_trading_date",
    ["lines"],
    "SELECT seq, cast(try_strptime(trading_date, '%Y%m%d') AS date) AS trading_date FROM lines",
)
def _(t):
    return t.lines.select("seq", dates.parse_trading_date(F.col("trading_date")).alias("trading_date"))


@query(
    "event_dates",
    ["event_rows"],
    "SELECT ex_date, record_date, count(*) AS n FROM event_rows GROUP BY ALL",
)
def _(t):
    days = t.events.select(
        dates.event_date(F.col("exrightDate")).alias("ex_date"),
        dates.event_date(F.col("recordDate")).alias("record_date"),
    )
    return days.groupBy("ex_date", "record_date").agg(F.count("*").alias("n"))


@query(
    "event_symbol",
    ["event_rows"],
    "SELECT symbol, event_type, count(*) AS n FROM event_rows GROUP BY ALL",
)
def _(t):
    named = t.events.select(
        text.event_symbol(F.col("ticker"), F.col("organCode")).alias("symbol"),
        text.event_type(F.col("eventCode")).alias("event_type"),
    )
    return named.groupBy("symbol", "event_type").agg(F.count("*").alias("n"))


@query(
    "average_price",
    ["bars"],
    f"""SELECT symbol, trading_date,
       ({" + ".join(PRICE_COLS)}) / 4.0 AS average_price FROM bars""",
)
def _(t):
    return snapshot.with_average_price(t.bars).select(*KEY, "average_price")


@query(
    "snapshot_round",
    ["bars"],
    f"""SELECT symbol, exchange, trading_date,
       {", ".join(f"cast(round({c} / 1000) AS bigint) AS {c}" for c in PRICE_COLS)},
       round(({" + ".join(PRICE_COLS)}) / 4.0, 1) AS average_price, total_volume FROM bars""",
)
def _(t):
    averaged = snapshot.with_average_price(t.bars)
    return snapshot.round_snapshot(averaged.withColumns({c: F.col(c) / 1000 for c in PRICE_COLS}))


@query(
    "encode_raw",
    ["ticks"],
    f"""SELECT symbol, trading_date,
       {", ".join(f"cast(round({c}) AS bigint) AS {c}" for c in PRICE_COLS)},
       total_volume, exchange, source FROM ticks""",
)
def _(t):
    return clean.encode_raw(t.ticks)


@query(
    "encode_adj",
    ["bars"],
    f"""SELECT symbol, trading_date,
       {", ".join(f"cast(round({c} / 1000, 2) AS decimal(18,2)) AS {c}" for c in PRICE_COLS)},
       total_volume, exchange, source FROM bars""",
)
def _(t):
    return clean.encode_adjusted(t.bars.withColumns({c: F.col(c) / 1000 for c in PRICE_COLS}))


@query(
    "report_symbols",
    ["bars"],
    """SELECT exchange, count(*) AS symbols,
       string_agg(symbol, ', ' ORDER BY symbol) FILTER (WHERE r <= 15)
         || CASE WHEN count(*) > 15 THEN ' (+' || cast(count(*) - 15 AS varchar) || ' mã khác)'
                 ELSE '' END AS text
FROM (SELECT exchange, symbol, row_number() OVER (PARTITION BY exchange ORDER BY symbol) AS r
      FROM (SELECT DISTINCT exchange, symbol FROM bars)) GROUP BY exchange""",
)
def _(t):
    return report.report_symbols(t.bars, ["exchange"])


@query("valid_bars", ["typed"], f"SELECT * FROM typed WHERE {FINITE} AND NOT {INVALID}")
def _(t):
    return clean.valid_bars(clean.sanitize_prices(typed(t)))


@query(
    "blacklist_filter",
    ["cleaned", "blacklist"],
    "SELECT * FROM cleaned WHERE symbol NOT IN (SELECT symbol FROM blacklist)",
)
def _(t):
    return clean.drop_blacklisted(cleaned(t), t.blacklist)


@query("day_slice", ["cleaned"], f"SELECT * FROM cleaned WHERE trading_date = DATE '{TODAY}'")
def _(t):
    return clean.day_slice(cleaned(t), TODAY)


_RULES = [
    ("symbol_format", "regexp_matches(symbol, '^[A-Z0-9_-]{3,12}$')"),
    ("trading_date_present", "trading_date IS NOT NULL"),
    *[(f"{c}_positive", f"{c} > 0") for c in PRICE_COLS],
    ("total_volume_not_negative", "total_volume >= 0"),
    ("exchange_present", "exchange IS NOT NULL"),
    ("source_present", "source IS NOT NULL"),
    ("high_ge_low", "high_price >= low_price"),
    ("high_ge_open", "high_price >= open_price"),
    ("high_ge_close", "high_price >= close_price"),
]
_LOW_RULES = [
    ("low_le_open", "low_price <= open_price"),
    ("low_le_close", "low_price <= close_price"),
]


@query(
    "contract_report",
    ["typed"],
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({ok}, false)) AS violations"
        " FROM typed"
        for name, ok in _RULES + _LOW_RULES
    ),
)
def _(t):
    return contract.contract_report(typed(t))


@query(
    "contract_rows",
    ["typed"],
    """SELECT seq, broken_rules FROM (SELECT seq, concat_ws(',', """
    + ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{name}' END" for name, ok in _RULES)
    + ") AS broken_rules FROM typed) WHERE broken_rules <> ''",
)
def _(t):
    return contract.contract_rows(typed(t)).select("seq", "broken_rules")


@query(
    "contract_enforced",
    ["board_clean"],
    "SELECT exchange, count(*) AS bars FROM board_clean GROUP BY exchange",
)
def _(t):
    checked = contract.enforce_contract(board_clean(t))
    return checked.groupBy("exchange").agg(F.count("*").alias("bars"))


@query("clean_board", ["board_clean"], "SELECT * FROM board_clean")
def _(t):
    return board_clean(t)


@query(
    "reattach_reference",
    ["board_clean"],
    """SELECT b.symbol, b.trading_date, b.close_price, b.total_volume, r.reference_price,
       r.average_price
FROM board_clean b LEFT JOIN (
  SELECT symbol, trading_date, reference_price, average_price FROM board_clean
  QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY time DESC, total_volume DESC) = 1
) r USING (symbol, trading_date)""",
)
def _(t):
    board = board_clean(t)
    bars = board.select(*KEY, "close_price", "total_volume")
    return clean.reattach_reference(bars, board, F.col("time"), F.col("total_volume"))


@query(
    "attach_exchange",
    ["bars", "listing"],
    f"""SELECT b.symbol, b.trading_date, b.close_price,
       coalesce(CASE WHEN l.symbol IS NOT NULL THEN {exchange_label("l.exchange")} END, 'Unknown')
         AS exchange
FROM bars b LEFT JOIN listing l ON l.symbol = b.symbol""",
)
def _(t):
    return clean.attach_exchange(t.bars.select(*KEY, "close_price"), t.listing)


@query(
    "max_trading_date",
    ["cleaned"],
    "SELECT max(trading_date) AS trading_date FROM cleaned",
)
def _(t):
    return tables.max_trading_date(cleaned(t))


@query(
    "distinct_symbols",
    ["cleaned"],
    "SELECT DISTINCT symbol FROM cleaned WHERE symbol <> ''",
)
def _(t):
    return symbols.distinct_symbols(cleaned(t))


@query(
    "latest_per_symbol",
    ["cleaned"],
    """SELECT * FROM cleaned
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC, seq DESC) = 1""",
)
def _(t):
    return snapshot.latest_per_symbol(cleaned(t), F.col("seq"))


@query(
    "dedup_bars",
    ["cleaned"],
    """SELECT * FROM cleaned
QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY seq DESC) = 1""",
)
def _(t):
    return clean.dedup_bars(cleaned(t), F.col("seq"))


_DOWNLOAD_CLEAN = f"""SELECT * FROM (
  SELECT symbol, time AS trading_date, open * 1000.0::double AS open_price,
         high * 1000.0::double AS high_price, low * 1000.0::double AS low_price,
         close * 1000.0::double AS close_price, volume AS total_volume, lower(source) AS source, seq
  FROM downloads) WHERE NOT {INVALID}"""


@query("clean_download", ["downloads"], _DOWNLOAD_CLEAN)
def _(t):
    return clean.clean_download(t.downloads, 1000.0)


@query(
    "dedup_history",
    ["downloads"],
    f"""SELECT * FROM ({_DOWNLOAD_CLEAN})
QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY seq DESC) = 1""",
)
def _(t):
    return clean.dedup_bars(clean.clean_download(t.downloads, 1000.0), F.col("seq"))


@query(
    "history_scan",
    ["downloads"],
    "SELECT * FROM downloads WHERE time >= DATE '1996-01-01' AND time <= DATE '2000-12-31'",
)
def _(t):
    return adjust.history_scan(t.downloads, "1996-01-01", "2000-12-31")


@query(
    "history_topk",
    ["downloads"],
    """SELECT * FROM downloads
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC, seq DESC) <= 5""",
)
def _(t):
    return adjust.history_topk(t.downloads, 5, F.col("seq"))


@query(
    "history_topk_large",
    ["board"],
    """SELECT upper(exchange) AS symbol, cast(make_timestamp(time * 1000) AS date) AS time, count(*) AS n
FROM (SELECT * FROM board QUALIFY row_number() OVER (
  PARTITION BY upper(exchange) ORDER BY cast(make_timestamp(time * 1000) AS date) DESC, time DESC, symbol DESC) <= 700)
GROUP BY 1, 2""",
)
def _(t):
    """A large limit over few, hot keys: the rows that stay, by key and day."""
    rows = t.board.select(
        F.upper("exchange").alias("symbol"),
        F.to_date(F.timestamp_millis("time")).alias("time"),
        F.col("time").alias("moment"),
        F.col("symbol").alias("seller"),
    )
    kept = adjust.history_topk(rows, 700, F.col("moment"), F.col("seller"))
    return kept.groupBy("symbol", "time").agg(F.count("*").alias("n"))


@query(
    "source_fallback",
    ["downloads"],
    """SELECT d.* FROM (
  SELECT *, CASE lower(source) WHEN 'vci' THEN 0 WHEN 'kbs' THEN 1 WHEN 'msn' THEN 2 END AS p
  FROM downloads) x JOIN downloads d USING (seq)
QUALIFY min(p) OVER (PARTITION BY x.symbol) = p""",
)
def _(t):
    return adjust.source_fallback(t.downloads, adjust.source_order("VCI"))


@query(
    "union_diagonal",
    ["corp_events"],
    """SELECT ticker, "exrightDate", "recordDate", NULL::varchar AS "exerciseRatio", 'DIV' AS kind
FROM corp_events WHERE "eventCode" = 'DIV'
UNION ALL SELECT ticker, "exrightDate", NULL, "exerciseRatio", 'ISS'
FROM corp_events WHERE "eventCode" = 'ISS'
UNION ALL SELECT ticker, NULL, NULL, NULL, 'other' FROM corp_events WHERE "eventCode" IS NULL""",
)
def _(t):
    code, source = F.col("eventCode"), t.events
    dividends = source.filter(code == "DIV").select("ticker", "exrightDate", "recordDate", F.lit("DIV").alias("kind"))
    issues = source.filter(code == "ISS").select("ticker", "exrightDate", "exerciseRatio", F.lit("ISS").alias("kind"))
    others = source.filter(code.isNull()).select("ticker", F.lit("other").alias("kind"))
    return clean.union_diagonal(dividends, issues, others)


@query(
    "event_date_per_symbol",
    ["event_rows"],
    """SELECT symbol, max(ex_date) AS ex_date FROM event_rows
WHERE ex_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND regexp_matches(symbol, '^[A-Z0-9]{3,10}$') GROUP BY symbol""",
)
def _(t):
    return events.event_date_per_symbol(events.corporate_actions(t.events, "1996-01-01", "2000-12-31"))


# The vote: benchmark tickers are not listed here, so the first 3 character symbol
# is looked for, and as symbols are longer the defaults apply. With benchmarks from
# the table itself every listed one votes.
_VOTERS = ["S00000003", "S00000007", "S00000011", "S00000013"]
_VOTER_LIST = ", ".join(f"'{v}'" for v in _VOTERS)
_VOTE_SQL = f"""
, last_board AS (SELECT upper(symbol) AS symbol, max_by(close_price, time) AS price FROM board
                 WHERE upper(symbol) IN ({_VOTER_LIST})
                   AND upper(symbol) IN (SELECT symbol FROM active) GROUP BY upper(symbol))
, last_week AS (SELECT symbol, max_by(close_price, trading_date) AS price FROM bars
                WHERE symbol IN ({_VOTER_LIST}) AND symbol IN (SELECT symbol FROM active)
                  AND trading_date BETWEEN DATE '{TODAY}' - 7 AND DATE '{TODAY}' GROUP BY symbol)
, votes AS (SELECT 'board' AS feed, CASE WHEN price < 1000 THEN 1000.0 ELSE 1.0 END AS m
            FROM last_board WHERE price > 0
            UNION ALL SELECT 'history', CASE WHEN price < 1000 THEN 1000.0 ELSE 1.0 END
            FROM last_week WHERE price > 0)
, multipliers AS (SELECT
  cast(coalesce((SELECT m FROM votes WHERE feed = 'board' GROUP BY m ORDER BY count(*) DESC, m LIMIT 1), 1.0)
    AS double) AS board_multiplier,
  cast(coalesce((SELECT m FROM votes WHERE feed = 'history' GROUP BY m ORDER BY count(*) DESC, m LIMIT 1), 1000.0)
    AS double) AS history_multiplier)
"""


def vote(t):
    history = t.bars.select("symbol", F.col("trading_date").alias("time"), F.col("close_price").alias("close"))
    return units.unit_vote(symbols.active_symbols(t.listing), t.board, history, _VOTERS, AS_OF)


@query("unit_vote", ["board", "bars", "active"], _VOTE_SQL + "SELECT * FROM multipliers")
def _(t):
    return vote(t)


@query(
    "unit_vote_default",
    ["board", "bars", "active"],
    """SELECT 1.0::double AS board_multiplier, 1000.0::double AS history_multiplier, n AS listed
FROM (SELECT count(*) AS n FROM active WHERE length(symbol) = 3 OR symbol IN ('FPT', 'HPG', 'VNM', 'VIC'))""",
)
def _(t):
    listed = symbols.active_symbols(t.listing)
    history = t.bars.select("symbol", F.col("trading_date").alias("time"), F.col("close_price").alias("close"))
    voted = units.unit_vote(listed, t.board, history, DEFAULT_BENCHMARKS, AS_OF)
    n = units.vote_candidates(listed, DEFAULT_BENCHMARKS).agg(F.count("*").alias("n")).scalar()
    return voted.withColumn("listed", n)


@query(
    "apply_unit_multiplier",
    ["board_bars", "bars", "active"],
    _VOTE_SQL
    + f"""SELECT symbol, trading_date, total_volume, exchange, source,
       {", ".join(f"{c} * board_multiplier AS {c}" for c in [*PRICE_COLS, "reference_price", "average_price"])}
FROM board_bars, multipliers""",
)
def _(t):
    factor = vote(t).select("board_multiplier").scalar()
    return clean.apply_multiplier(board_bars(t), factor, ["reference_price", "average_price"])
