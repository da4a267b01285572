"""SQL for DuckDB that gives the result of each registered query from the test tables."""

from __future__ import annotations

from candlewick.dims import EXCHANGES
from candlewick.queries import CHECK_FROM, EVENT_RANGE, NOW

ORACLE: dict[str, str] = {}

KEY = "exchange, trading_type, symbol, interval, open_time"
SERIES = "exchange, trading_type, symbol, interval"
COLUMNS = f"{KEY}, open_price, close_time, close_price, low, high, volume, status"


def _events(exchange: str, interval: str = "1h", seconds: int = 3600) -> str:
    return f"""
    SELECT '{exchange}' AS exchange, 'SPOT' AS trading_type, symbol, '{interval}' AS interval,
      (t // {seconds}) * {seconds} AS open_time, CAST(arg_min(price, ts) AS VARCHAR) AS open_price,
      (t // {seconds}) * {seconds} + {seconds} AS close_time, CAST(arg_max(price, ts) AS VARCHAR) AS close_price,
      CAST(min(price) AS VARCHAR) AS low, CAST(max(price) AS VARCHAR) AS high,
      CAST(sum(price) AS VARCHAR) AS volume, '__NON_CHECK__' AS status
    FROM (SELECT upper(event_type) || '/USD' AS symbol, epoch_us(ts) // 1000000 AS t, ts,
            CAST(value AS DECIMAL(18,2)) AS price FROM events)
    GROUP BY symbol, t // {seconds}"""


def _orders(exchange: str, interval: str) -> str:
    unit = {"1d": "day", "1mo": "month"}[interval]
    return f"""
    SELECT '{exchange}' AS exchange, 'SPOT' AS trading_type, symbol, '{interval}' AS interval,
      epoch_us(b) // 1000000 AS open_time, CAST(first(price ORDER BY ts, k) AS VARCHAR) AS open_price,
      epoch_us(b + INTERVAL 1 {unit}) // 1000000 AS close_time, CAST(last(price ORDER BY ts, k) AS VARCHAR) AS close_price,
      CAST(min(price) AS VARCHAR) AS low, CAST(max(price) AS VARCHAR) AS high,
      CAST(sum(price) AS VARCHAR) AS volume, '__NON_CHECK__' AS status
    FROM (SELECT regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') || '/USD' AS symbol, o_orderdate AS ts,
            CAST(date_trunc('{unit}', o_orderdate) AS TIMESTAMP) AS b, o_orderkey AS k,
            CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
    GROUP BY symbol, b"""


_HISTORY = f"history AS ({_events('binance')} UNION ALL {_orders('bybit', '1d')} UNION ALL {_orders('okx', '1mo')})"
_HOURS = f"hours AS ({_events('binance')})"

_DENTED = """dented AS (SELECT * REPLACE (CASE
    WHEN interval = '1h' AND (open_time // 3600) % 41 = 7 THEN close_time - 60
    WHEN interval = '1d' AND (open_time // 86400) % 53 = 7 THEN close_time + 3600
    ELSE close_time END AS close_time) FROM history)"""


def _part_checked(source: str) -> str:
    return f"""part_checked AS (SELECT * REPLACE (CASE (open_time // 3600) % 3
    WHEN 0 THEN '__OK__' WHEN 1 THEN '__ERROR__' ELSE '__NON_CHECK__' END AS status) FROM {source})"""


_MONTH_LENGTH = "epoch_us(date_trunc('month', make_timestamp(open_time * 1000000)) + INTERVAL 1 MONTH) // 1000000 - open_time"


def _checked(source: str, where: str = "true") -> str:
    return f"""linked AS (SELECT *, lead(open_time) OVER (PARTITION BY {SERIES} ORDER BY open_time) AS next_open,
      CASE interval WHEN '1h' THEN 3600 WHEN '1d' THEN 86400 ELSE {_MONTH_LENGTH} END AS delta
    FROM {source} WHERE {where}),
  checked AS (SELECT *, CASE WHEN next_open IS NULL THEN status
      WHEN close_time = next_open AND close_time - open_time = delta THEN '__OK__'
      ELSE '__ERROR__' END AS checked FROM linked)"""


_VERDICT = "verdict AS (SELECT * EXCLUDE (next_open, delta, checked) REPLACE (checked AS status) FROM checked)"


def _typed(source: str, more: str = "") -> str:
    prices = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("open_price", "close_price", "low", "high", "volume"))
    return f"SELECT {KEY}, close_time, {prices}, status{more} FROM {source}"


def _streams(source: str) -> str:
    """Runs of OK rows, by the count of rows that are not OK before them."""
    return f"""marked AS (SELECT *, status IS NOT DISTINCT FROM '__OK__' AS ok,
      lag(status IS NOT DISTINCT FROM '__OK__') OVER (PARTITION BY {SERIES} ORDER BY open_time) AS before FROM {source}),
  streams AS (SELECT *, sum(CASE WHEN ok AND NOT coalesce(before, false) THEN 1 ELSE 0 END)
      OVER (PARTITION BY {SERIES} ORDER BY open_time)::BIGINT - 1 AS stream_no FROM marked)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n  ".join(parts) + "\n"


_TYPE_TEXT = "strftime(make_timestamp({} * 1000000), '%Y-%m-%d %H:%M:%S')"
_IN_RANGE = f"open_time >= {EVENT_RANGE[0]} AND close_time <= {EVENT_RANGE[1]}"

# Reads

ORACLE["range_read"] = _with(_HISTORY, _checked("history"), _VERDICT) + _typed("verdict") + f" WHERE {_IN_RANGE}"
ORACLE["typed_read"] = _with(_HISTORY) + _typed("history")
ORACLE["table_read"] = (
    _with(_HISTORY, _checked("history"), _VERDICT)
    + _typed("verdict")
    + " WHERE exchange = 'bybit' AND interval = '1d' AND open_time >= 852076800 AND close_time <= 915148800"
)
ORACLE["status_filters"] = _with(_HISTORY, _part_checked("history")) + f"""
SELECT {SERIES}, count(*) AS n, 'unchecked' AS kind FROM part_checked WHERE status = '__NON_CHECK__' GROUP BY ALL
UNION ALL SELECT {SERIES}, count(*) AS n, 'not_ok' AS kind FROM part_checked WHERE status <> '__OK__' GROUP BY ALL"""

# Check

ORACLE["consistency_check"] = _with(_HISTORY, _DENTED, _checked("dented")) + (
    f"SELECT {KEY}, close_time, next_open, checked FROM checked"
)
ORACLE["check_errors"] = _with(_HISTORY, _DENTED, _checked("dented")) + f"""
SELECT {KEY}, {_TYPE_TEXT.format('open_time')} AS open_date, close_time, {_TYPE_TEXT.format('close_time')} AS close_date,
  checked AS status, close_time - open_time AS diff_open_close, next_open - open_time AS diff_data
FROM checked WHERE checked = '__ERROR__'"""
ORACLE["check_summary"] = _with(_HISTORY, _DENTED, _part_checked("dented"), _checked("part_checked")) + f"""
SELECT {SERIES}, count(*) FILTER (checked = '__ERROR__') AS result_counter, max(open_time) AS last_open_time_check
FROM checked GROUP BY ALL"""
_STEP_31 = "CASE interval WHEN '1h' THEN 3600 WHEN '1d' THEN 86400 ELSE 31 * 86400 END"
_STEP_28 = "CASE interval WHEN '1h' THEN 3600 WHEN '1d' THEN 86400 ELSE 28 * 86400 END"


def _check_from(start: str) -> str:
    late = f"open_time >= greatest({start} - 5 * {_STEP_31}, 0)"
    return _with(_HISTORY, _DENTED, _checked("dented", late)) + f"""
SELECT {KEY}, next_open, checked FROM checked
QUALIFY max(open_time) OVER (PARTITION BY {SERIES}) > {start}"""


ORACLE["check_from"] = _check_from(str(CHECK_FROM))
ORACLE["recheck_window"] = _check_from(f"abs({NOW} - 100 * {_STEP_28})")
_CHANGES = (_HISTORY, _DENTED, _part_checked("dented"), _checked("part_checked"))
ORACLE["status_changes"] = _with(*_CHANGES) + f"""
SELECT {KEY}, status AS old_status, checked AS status FROM checked WHERE checked IS DISTINCT FROM status"""
ORACLE["status_writeback"] = _with(*_CHANGES) + f"SELECT {KEY}, close_time, checked AS status FROM checked"

# Streams

ORACLE["consistent_streams"] = _with(_HISTORY, _DENTED, _checked("dented"), _VERDICT, _streams("verdict")) + (
    f"SELECT {KEY}, close_time, close_price, stream_no FROM streams WHERE ok"
)
ORACLE["stream_windows"] = _with(f"history AS ({_events('binance')})", _DENTED, _checked("dented"), _VERDICT, _streams("verdict")) + f"""
SELECT {KEY}, stream_no, max(close_price::DOUBLE) OVER (PARTITION BY {SERIES}, stream_no ORDER BY open_time ROWS 2 PRECEDING) AS highest
FROM streams WHERE ok"""
ORACLE["stream_running_high"] = _with(f"history AS ({_events('binance')})", _DENTED, _checked("dented"), _VERDICT, _streams("verdict")) + f"""
SELECT {KEY}, stream_no, max(close_price::DOUBLE) OVER whole AS highest, row_number() OVER whole AS candle_no
FROM streams WHERE ok WINDOW whole AS (PARTITION BY {SERIES}, stream_no ORDER BY open_time)"""
ORACLE["streams_in_range"] = (
    _with(
        _HISTORY,
        _part_checked("history"),
        f"ranged AS (SELECT * FROM part_checked WHERE {_IN_RANGE})",
        _streams("ranged"),
    )
    + _typed("streams", ", stream_no")
    + " WHERE ok"
)
ORACLE["consistent_streams_nested"] = _with(_HISTORY, _checked("history"), _VERDICT, _streams("verdict")) + f"""
SELECT {SERIES}, stream_no, open_time // 1048576 AS segment_no, count(*) AS n, min(open_time) AS first_open,
  arg_max(close_time, open_time) AS last_close, arg_max(close_price, open_time) AS last_price
FROM streams WHERE ok GROUP BY ALL"""

# Extent

_PROFILE = f"""profile AS (SELECT {SERIES}, min(open_time) AS first_open, max(open_time) AS last_open,
    max(close_time) AS last_close,
    coalesce(min(open_time) FILTER (status = '__NON_CHECK__'), 0) AS min_unchecked,
    coalesce(max(open_time) FILTER (status <> '__OK__'), min(open_time)) AS min_valid,
    count(*) AS n_candles, count(*) FILTER (status = '__ERROR__') AS n_errors
  FROM {{}} GROUP BY ALL)"""
_REQUESTS = f"""requests AS (SELECT DISTINCT {SERIES} FROM history UNION ALL
  SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'binance' ELSE 'kucoin' END, 'SPOT', n_name || '/USD', '1h' FROM nation)"""
_LISTED = f"""listed AS (SELECT {SERIES}, coalesce(p.last_close, 0) AS last_close,
    CASE WHEN p.first_open IS NOT NULL THEN date_trunc('month', make_timestamp(p.first_open * 1000000))
           + CASE WHEN exchange = 'binance' THEN INTERVAL 0 MONTH ELSE INTERVAL 1 MONTH END
         WHEN exchange = 'binance' THEN TIMESTAMP '2018-01-01' ELSE TIMESTAMP '2024-01-01' END AS first_month
  FROM requests LEFT JOIN profile p USING ({SERIES})),
  water AS (SELECT *, CASE WHEN last_close > 0 THEN last_close ELSE epoch_us(first_month) // 1000000 END AS high_water
  FROM listed),
  marked AS (SELECT *, high_water < {NOW} - (2 * {_STEP_28} + 1) AS stale FROM water)"""
_EXTENT = (_HISTORY, _PROFILE.format("history"), _REQUESTS, _LISTED)

ORACLE["series_profile"] = _with(_HISTORY, _part_checked("history"), _PROFILE.format("part_checked")) + "SELECT * FROM profile"
ORACLE["min_valid_historical"] = _with(
    _HISTORY, _checked("history"), _VERDICT, _PROFILE.format("verdict"), _REQUESTS
) + f"""
SELECT {SERIES}, coalesce(min_valid, 0) AS min_valid, coalesce(min_unchecked, 0) AS min_unchecked
FROM requests LEFT JOIN profile USING ({SERIES})"""
ORACLE["first_listed"] = _with(*_EXTENT) + f"""
SELECT {SERIES}, year(first_month)::INTEGER AS first_year, month(first_month)::INTEGER AS first_month,
  epoch_us(first_month) // 1000000 AS first_month_time FROM listed"""
ORACLE["staleness"] = _with(*_EXTENT) + f"SELECT {SERIES}, high_water, stale FROM marked"
ORACLE["series_exists"] = _with(_HISTORY, _REQUESTS) + f"""
SELECT {SERIES}, n IS NOT NULL AS present
FROM requests LEFT JOIN (SELECT {SERIES}, count(*) AS n FROM history GROUP BY ALL) USING ({SERIES})"""

# Merge

_INCOMING = """incoming AS (SELECT exchange, trading_type, symbol, interval, open_time + shift * 60 AS open_time,
    open_price, close_time, close_price, CASE WHEN seq = 1 THEN low END AS low, high, volume || ':' || seq AS volume, status, seq
  FROM history, (VALUES (1), (2)) AS v(seq), (VALUES (0), (1)) AS s(shift) WHERE high <> low),
  latest AS (SELECT * EXCLUDE (seq) FROM incoming WHERE seq = 2)"""
# Stored and new rows one below the other; each key takes its values from the new one, if there is one, and its status from the stored one.
_VALUES = "{{'open_price': open_price, 'close_time': close_time, 'close_price': close_price, 'low': low, 'high': high, 'volume': volume}}"
_MERGED = f"""SELECT {KEY}, n.open_price, n.close_time, n.close_price, n.low, n.high, n.volume, status FROM (
  SELECT {KEY}, arg_max(v, turn) AS n, CASE WHEN min(turn) = 0 THEN max(old) ELSE '__NON_CHECK__' END AS status
  FROM (SELECT {KEY}, {_VALUES} AS v, status AS old, 0 AS turn FROM {{}}
    UNION ALL SELECT {KEY}, {_VALUES} AS v, NULL AS old, 1 AS turn FROM {{}}) GROUP BY {KEY})"""
ORACLE["dedupe_last_wins"] = _with(_HISTORY, _INCOMING) + f"SELECT {COLUMNS} FROM latest"
ORACLE["upsert_merge"] = _with(_HISTORY, _part_checked("history"), _INCOMING) + _MERGED.format("part_checked", "latest")
ORACLE["upsert_store"] = ORACLE["upsert_merge"]
ORACLE["table_profile"] = (
    _with(_HISTORY, _part_checked("history"), _INCOMING, f"merged AS ({_MERGED.format('part_checked', 'latest')})", _PROFILE.format("merged"))
    + "SELECT * FROM profile"
)
_FIRST = f"""firsts AS (SELECT {SERIES}, make_timestamp(min(open_time) * 1000000)
    + CASE WHEN {{}} THEN INTERVAL 2 MONTH ELSE INTERVAL 0 MONTH END AS d FROM history GROUP BY {SERIES})"""
_META = "'{\"year\":' || year(d) || ',\"month\":' || month(d) || '}'"
ORACLE["meta_upsert"] = _with(_HISTORY, _FIRST.format("exchange <> 'binance'")) + f"""
SELECT {SERIES}, 'first_year_month_listed' AS cache_type, {_META} AS data,
  sha256('_____' || exchange || '_' || symbol || '_' || interval || '_' || trading_type || '_first_year_month_listed_____')
    AS key_sha256_hash FROM firsts"""
ORACLE["meta_lookup"] = _with(_HISTORY, _REQUESTS, _FIRST.format("false")) + f"""
SELECT {SERIES}, 'first_year_month_listed' AS cache_type, {_META} AS data FROM requests LEFT JOIN firsts USING ({SERIES})"""

# Payloads: the candles themselves, less the one each exchange leaves out.

_KEPT = {
    "binance": "newest > 1",
    "binanceus": "newest > 1",
    "bybit": "newest > 1 OR n = 1",
    "okx": "(open_time // 3600) % 5 <> 0",
    "kucoin": "true",
    "bingx": "newest > 1 OR n = 1",
    "newcomer": "(open_time // 3600) % 5 <> 0",
}
for _name in _KEPT:
    ORACLE[f"payload_normalise_{_name}" if _name in EXCHANGES else "payload_new_exchange"] = f"""
WITH hours AS ({_events(_name)}),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol, open_time // 86400 ORDER BY open_time DESC) AS newest,
    count(*) OVER (PARTITION BY symbol, open_time // 86400) AS n FROM hours),
  kept AS (SELECT *, row_number() OVER (PARTITION BY symbol, open_time // 86400 ORDER BY open_time) - 1 AS pos
    FROM numbered WHERE {_KEPT[_name]})
SELECT '{_name}:' || symbol || ':' || (open_time // 86400) AS payload_id, pos, {COLUMNS} FROM kept"""

_BODIES = """bodies AS (SELECT event_type AS exchange, ts, event_id,
    CASE WHEN (epoch_us(ts) // 86400000000) % 5 = 0 THEN regexp_replace(props, ': (\\d+)', ': "\\1"') ELSE props END AS whole,
    CASE WHEN event_id % 7 = 0 THEN left(whole, 4) ELSE whole END AS body FROM events)"""
ORACLE["payload_quarantine"] = _with(_BODIES) + """
SELECT exchange, count(*) AS n, json_valid(body) AS json FROM bodies GROUP BY ALL"""
ORACLE["payload_drift"] = _with(
    _BODIES,
    """kinds AS (SELECT exchange, CAST(ts AS DATE) AS day, string_agg(DISTINCT json_structure(body)::VARCHAR) AS kind
  FROM bodies WHERE json_valid(body) GROUP BY ALL)""",
) + """
SELECT exchange, CAST(day AS VARCHAR) AS day, coalesce(kind <> lag(kind) OVER (PARTITION BY exchange ORDER BY day), false) AS drifted FROM kinds"""
ORACLE["payload_parity"] = "SELECT event_id, event_id % 3 <> 0 AS same FROM events"

# Catalogs and requests

_PAIRS = """pairs AS (SELECT n_nationkey, n_name AS base, replace(r_name, ' ', '') AS quote
  FROM nation JOIN region ON n_regionkey = r_regionkey),
  exchanges AS (SELECT unnest(['binance', 'binanceus', 'bingx', 'bybit', 'kucoin', 'okx']) AS exchange),
  catalog AS (SELECT exchange, CASE WHEN exchange = 'bingx' THEN lower(base) ELSE upper(base) END || '/' || upper(quote) AS symbol,
    row_number() OVER (PARTITION BY exchange ORDER BY n_nationkey) AS pos FROM exchanges, pairs)"""
_CUSTOMERS = """customers AS (SELECT c_custkey,
    ['binance', 'binanceus', 'bingx', 'bybit', 'kucoin', 'okx'][c_custkey % 6 + 1] AS exchange, upper(n_name) AS base,
    CASE WHEN c_custkey % 5 = 0 THEN 'NONE' ELSE replace(r_name, ' ', '') END AS quote
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
ORACLE["symbol_catalog"] = _with(_PAIRS) + "SELECT exchange, symbol, pos::INTEGER AS pos FROM catalog"
ORACLE["symbol_list"] = _with(_PAIRS) + """
SELECT exchange, symbol, (row_number() OVER (PARTITION BY exchange ORDER BY symbol) - 1)::INTEGER AS place FROM catalog"""
ORACLE["symbol_map"] = _with(_PAIRS, _CUSTOMERS) + """
SELECT c_custkey, u.exchange, base || CASE WHEN u.exchange IN ('okx', 'kucoin', 'bingx') THEN '-' ELSE '' END || quote AS native_symbol,
  coalesce(c.symbol, native_symbol) AS symbol
FROM customers u LEFT JOIN catalog c ON c.exchange = u.exchange AND lower(c.symbol) = lower(base || '/' || quote)"""
ORACLE["native_symbols"] = _with(_PAIRS, _CUSTOMERS) + """
SELECT c_custkey, u.exchange, base || '/' || quote AS symbol,
  CASE WHEN c.symbol IS NULL THEN base || '/' || quote
    ELSE base || CASE WHEN u.exchange IN ('okx', 'kucoin', 'bingx') THEN '-' ELSE '' END || quote END AS native_symbol
FROM customers u LEFT JOIN catalog c ON c.exchange = u.exchange AND c.symbol = base || '/' || quote"""
ORACLE["interval_codes"] = _with(
    _HISTORY,
    """codes(exchange, interval, native_interval) AS (VALUES
  ('binance', '1h', '1h'), ('binance', '1d', '1d'), ('binance', '1mo', '1mo'),
  ('binanceus', '1h', '1h'), ('binanceus', '1d', '1d'), ('binanceus', '1mo', '1mo'),
  ('bybit', '1h', '60'), ('bybit', '1d', 'D'), ('bybit', '1mo', 'M'),
  ('okx', '1h', '1H'), ('okx', '1d', '1Dutc'), ('okx', '1mo', '1Mutc'),
  ('kucoin', '1h', '1hour'), ('kucoin', '1d', '1day'), ('kucoin', '1mo', '1month'),
  ('bingx', '1h', '1h'), ('bingx', '1d', '1d'), ('bingx', '1mo', '1M'))""",
) + """
SELECT c.exchange, s.symbol, s.interval, c.native_interval
FROM (SELECT DISTINCT symbol, interval FROM history) s JOIN codes c USING (interval)"""
ORACLE["fetch_spec_validate"] = _with(
    _PAIRS,
    _CUSTOMERS,
    """specs AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'nowhere' ELSE exchange END AS exchange,
    CASE WHEN customers.exchange = 'bingx' THEN lower(base) ELSE base END || '/' || quote AS symbol,
    ['1m', '8h', '3d', '1mo', '7m'][c_custkey % 7 % 5 + 1] AS interval FROM customers)""",
) + """
SELECT c_custkey, s.exchange, s.symbol, s.interval, CASE WHEN s.exchange = 'nowhere' THEN 'unknown exchange'
  WHEN c.symbol IS NULL THEN 'unknown symbol'
  WHEN interval = '7m' OR (interval = '8h' AND s.exchange IN ('bybit', 'okx'))
    OR (interval = '3d' AND s.exchange IN ('bybit', 'kucoin')) THEN 'unsupported interval' END AS reason
FROM specs s LEFT JOIN catalog c ON c.exchange = s.exchange AND c.symbol = s.symbol"""

# Plans

_LIMITS = "CASE exchange WHEN 'okx' THEN 100 WHEN 'bingx' THEN 500 ELSE 1000 END"
ORACLE["backfill_plan"] = _with(
    *_EXTENT, f"stepped AS (SELECT *, {_STEP_28} AS delta, {_LIMITS} AS lim FROM marked WHERE stale)",
    f"""starts AS (SELECT *, unnest(generate_series(greatest(high_water - 10 * delta, 0)::BIGINT, {NOW}::BIGINT, (lim * delta)::BIGINT))
    AS request_start FROM stepped)""",
) + f"""
SELECT {SERIES}, request_start, CASE WHEN exchange = 'okx' AND request_start >= {NOW} - 250 * delta THEN 300 ELSE lim END AS "limit"
FROM starts"""

# As of 2024-03-20 16:00: nothing stored yet of CLICK, whose first month is January as well;
# the others were last stored in January and start in December.
_MONTHS = """series AS (SELECT DISTINCT 'binance' AS exchange, 'SPOT' AS trading_type, upper(event_type) || '/USD' AS symbol,
    '1h' AS interval, upper(event_type) AS bare FROM events),
  months AS (SELECT *, CAST(unnest(generate_series(CASE WHEN symbol = 'CLICK/USD' THEN DATE '2024-01-01' ELSE DATE '2023-12-01' END,
    DATE '2024-02-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM series),
  monthly AS (SELECT *, bare || 'USD-1h-' || strftime(month, '%Y-%m') || '.zip' AS file FROM months),
  daily AS (SELECT *, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM months),
  days AS (SELECT *, bare || 'USD-1h-' || strftime(day, '%Y-%m-%d') || '.zip' AS file FROM daily)"""
ORACLE["archive_manifest"] = _with(_MONTHS) + f"""
SELECT {SERIES}, CAST(month AS VARCHAR) AS month, 'monthly' AS kind, file FROM monthly
UNION ALL SELECT {SERIES}, CAST(month AS VARCHAR), 'daily', file FROM days"""
ORACLE["archive_manifest_landed"] = _with(_MONTHS) + f"""
SELECT {SERIES}, CAST(month AS VARCHAR) AS month, 'monthly' AS kind, file FROM monthly WHERE month(month) = 1
UNION ALL SELECT {SERIES}, CAST(month AS VARCHAR), 'daily', file FROM days WHERE month(month) <> 1 AND day(day) >= 10"""
ORACLE["archive_ingest"] = _with(_HOURS) + f"""
SELECT {COLUMNS} FROM hours WHERE dayofweek(make_timestamp(open_time * 1000000)) BETWEEN 1 AND 5"""
ORACLE["archive_stream_load"] = ORACLE["archive_ingest"] + " AND open_time // 86400 % 5 <> 0"

# Repair

_ERRORS = (
    _HISTORY,
    _DENTED,
    _part_checked("dented"),
    _checked("part_checked"),
    f"""wanted AS (SELECT {KEY}, open_time - {_STEP_31} // 2 AS request_start, delta FROM checked WHERE checked = '__ERROR__')""",
    f"""batches AS (SELECT w.exchange, w.trading_type, w.symbol, w.interval, w.open_time AS error_time, w.request_start, w.delta, k,
    h.open_time, h.open_price, h.close_time, h.close_price, h.low, h.high, CAST(w.request_start AS VARCHAR) AS volume, h.status
  FROM wanted w, (VALUES (0), (1), (2)) AS v(k), history h
  WHERE (h.exchange, h.trading_type, h.symbol, h.interval) = (w.exchange, w.trading_type, w.symbol, w.interval)
    AND h.open_time = w.open_time + k * w.delta)""",
    f"""answers AS (SELECT {SERIES}, request_start, count(*) FILTER (k = 1) = 1 AS accepted FROM batches GROUP BY ALL)""",
)
ORACLE["repair_accept"] = _with(*_ERRORS) + f"SELECT {SERIES}, request_start, accepted FROM answers"
ORACLE["repair_apply"] = _with(
    *_ERRORS,
    f"""good AS (SELECT b.* FROM batches b JOIN answers a USING ({SERIES}, request_start) WHERE accepted
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY request_start DESC) = 1)""",
) + _MERGED.format("part_checked", "good")
_REACH = "CASE interval WHEN '1h' THEN 1000 * 3600 WHEN '1d' THEN 1000 * 86400 ELSE 100 * 31 * 86400 END"
ORACLE["repair_from_pool"] = _with(
    *_ERRORS,
    f"""starts AS (SELECT {SERIES}, request_start FROM answers WHERE accepted)""",
) + f"""
SELECT {COLUMNS} FROM history h ASOF JOIN starts s
  ON h.exchange = s.exchange AND h.trading_type = s.trading_type AND h.symbol = s.symbol AND h.interval = s.interval
  AND h.open_time >= s.request_start
WHERE h.open_time < s.request_start + CASE h.interval WHEN '1h' THEN 1000 * 3600 WHEN '1d' THEN 1000 * 86400 ELSE 100 * 31 * 86400 END"""
ORACLE["repair_from_pool"] = ORACLE["repair_from_pool"].replace(
    f"SELECT {COLUMNS} FROM history h", "SELECT " + ", ".join(f"h.{c.strip()}" for c in COLUMNS.split(",")) + " FROM history h"
)

# Live

ORACLE["live_tail"] = f"""
WITH feeds AS (SELECT *, (open_time // 3600) % 4 <> 0 AS closed FROM ({_events('binance')})
    UNION ALL SELECT *, true FROM ({_events('kucoin')}) UNION ALL SELECT *, true FROM ({_events('okx', '1m', 60)})),
  recent AS (SELECT * FROM feeds QUALIFY row_number() OVER (PARTITION BY {SERIES} ORDER BY open_time DESC)
    <= CASE interval WHEN '1m' THEN 27 ELSE 9 END)
SELECT {COLUMNS} FROM recent WHERE closed
QUALIFY exchange <> 'kucoin' OR row_number() OVER (PARTITION BY {SERIES} ORDER BY open_time DESC) > 1"""
ORACLE["load_live"] = f"""
WITH feeds AS (SELECT *, (open_time // 3600) % 4 <> 0 AS closed FROM ({_events('binance')})
    UNION ALL SELECT *, true FROM ({_events('kucoin')}) UNION ALL SELECT *, true FROM ({_events('okx', '1m', 60)}))
SELECT {COLUMNS} FROM feeds WHERE closed
QUALIFY exchange <> 'kucoin' OR row_number() OVER (PARTITION BY {SERIES} ORDER BY open_time DESC) > 1"""
ORACLE["stream_upsert"] = f"""
WITH flagged AS ({_events('binance')}), unflagged AS ({_events('kucoin')})
SELECT {COLUMNS} FROM (SELECT * REPLACE (CASE WHEN high <> low THEN 'corrected' ELSE volume END AS volume)
  FROM flagged WHERE high <> low OR (open_time // 3600) % 4 <> 0)
UNION ALL SELECT {COLUMNS} FROM (SELECT * FROM unflagged
  QUALIFY row_number() OVER (PARTITION BY {SERIES} ORDER BY open_time DESC) > 1)"""
ORACLE["stream_continuity"] = _with(
    f"history AS ({_events('binance')})", _DENTED, _checked("dented")
) + f"SELECT {KEY}, close_time, next_open, checked FROM checked WHERE next_open IS NOT NULL"

ORACLE["stream_verdict_revisions"] = _with(
    f"history AS ({_events('binance')})",
    _DENTED,
    _checked("dented"),
    f"""early AS (SELECT {KEY}, lead(open_time) OVER (PARTITION BY {SERIES} ORDER BY open_time) AS early_open
    FROM dented WHERE (open_time // 3600) % 5 <> 0)""",
) + f"""SELECT {KEY}, close_time, next_open, checked, coalesce(early_open, next_open) AS first_next_open,
  CASE WHEN early_open IS NULL THEN checked WHEN close_time = early_open AND close_time - open_time = delta THEN '__OK__'
  ELSE '__ERROR__' END AS first_checked
FROM checked LEFT JOIN early USING ({KEY}) WHERE next_open IS NOT NULL"""

# Expressions

ORACLE["calendar_exprs"] = """
WITH o AS (SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS t,
    make_timestamp(t * 1000000) AS ts, CAST(make_timestamp(t * 1000000) AS DATE) AS d,
    CAST(date_trunc('month', make_timestamp(t * 1000000)) AS DATE) AS m, CAST(o_orderkey % 4 + 1 AS INTEGER) AS n,
    t * 1000 + o_orderkey * 37 % 1000 AS ms FROM orders)
SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, year(d)::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
  date_diff('day', m, CAST(m + INTERVAL 1 MONTH AS DATE)) * 86400 AS month_seconds,
  date_diff('day', m, CAST(m + to_months(n) AS DATE)) * 86400 AS months_seconds,
  n::BIGINT * 28 * 86400 AS plain_months_seconds, (o_orderkey % 9 + 1) * 604800 AS weeks_seconds,
  epoch_us(m + INTERVAL 1 MONTH) // 1000000 AS next_month_time,
  CAST(CAST(m - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS previous_month, CAST(CAST(m + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month,
  CAST(CASE WHEN m = DATE '1998-07-01' THEN m ELSE CAST(m + INTERVAL 1 MONTH AS DATE) END AS VARCHAR) AS next_month_until,
  CAST(d - 1 AS VARCHAR) AS previous_day, CAST(CASE WHEN d = DATE '1998-07-15' THEN d ELSE d + 1 END AS VARCHAR) AS next_day,
  least(900000000 - epoch_us(CAST(d AS TIMESTAMP)) // 1000000, 86400) AS since_midnight,
  date_diff('month', m, DATE '1998-07-01')::INTEGER AS months_ago,
  CASE WHEN ms % 1000 = 500 THEN ms // 1000 + (ms // 1000) % 2 ELSE (ms + 500) // 1000 END AS rounded,
  t + 1 AS from_micros, t AS from_millis
FROM o"""
ORACLE["series_names"] = _with(_HISTORY) + f"""
SELECT {SERIES}, year(make_timestamp(open_time * 1000000))::INTEGER AS year, count(*) AS n,
  exchange || '__spot__' || lower(replace(symbol, '/', '_')) || '__' || interval AS series_name,
  series_name || '__' || year AS partition_name,
  sha256('_____' || exchange || '_' || symbol || '_' || interval || '_' || trading_type || '_kind_____') AS key
FROM history GROUP BY ALL"""
