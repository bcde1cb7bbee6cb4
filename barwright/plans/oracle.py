"""ANSI SQL (for DuckDB) that gives the same rows as the queries of the registry."""

from __future__ import annotations

P = "DECIMAL(28,8)"
NEWEST = "seq DESC, open DESC, high DESC, low DESC, close DESC, volume DESC"
BARS = "symbol, dt, open, high, low, close, volume"
BRONZE = f"{BARS}, source, seq"
COMPLETE = ("symbol IS NOT NULL AND dt IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL "
            "AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL")
BROKEN_OHLC = "(low > least(open, close) OR high < greatest(open, close))"
CLAMPED = "CAST(greatest(0, coalesce(volume, 0)) AS BIGINT)"


def _priced(columns: str) -> str:
    return ", ".join(f"CAST({c} AS {P}) AS {c}" for c in columns.split())


FEED = f"""
feed_priced AS (
  SELECT event_id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS p,
         CAST(CAST(value AS DECIMAL(18,2)) + (event_id % 11) * 0.01 AS DECIMAL(18,2)) AS c
  FROM events),
feed_raw AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE concat('U', lpad(CAST(user_id AS VARCHAR), 4, '0')) END AS symbol,
         CAST(ts AS DATE) AS dt,
         p AS open,
         CAST(greatest(p, c) + (event_id % 3) * 0.01 AS DECIMAL(18,2)) AS high,
         CAST(least(p, c) - (event_id % 4) * 0.01 AS DECIMAL(18,2)) AS low,
         CASE WHEN event_id % 41 = 0 THEN NULL
              WHEN event_id % 53 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE c END AS close,
         CASE WHEN event_id % 29 = 0 THEN NULL
              WHEN event_id % 31 = 0 THEN CAST(-1 - event_id % 100 AS BIGINT)
              ELSE CAST((event_id * 37) % 10000 AS BIGINT) END AS volume,
         event_id AS seq, ts
  FROM feed_priced),
feed AS (
  SELECT symbol, dt, {_priced("open high low close")}, volume, 'feed' AS source, seq
  FROM feed_raw)"""

BULK = f"""
bulk_priced AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem),
bulk AS (
  SELECT concat('S', lpad(CAST(l_suppkey AS VARCHAR), 4, '0')) AS symbol,
         CAST(l_shipdate AS DATE) AS dt,
         CAST(p AS {P}) AS open,
         CAST(p + 1 AS {P}) AS high,
         CAST(p - 1 AS {P}) AS low,
         CAST(p + (l_linenumber % 3) - 1 AS {P}) AS close,
         CAST(l_quantity AS BIGINT) AS volume,
         'bulk' AS source,
         l_orderkey * 10 + l_linenumber AS seq
  FROM bulk_priced)"""

BOTH = f"{FEED},{BULK},\nbronze AS (SELECT {BRONZE} FROM feed UNION ALL SELECT {BRONZE} FROM bulk)"

RESTATED = f"""
restated AS (
  SELECT symbol, CAST(dt + INTERVAL 7 DAY AS DATE) AS dt,
         CAST(open + 1 AS {P}) AS open, CAST(high + 1 AS {P}) AS high,
         CAST(low + 1 AS {P}) AS low, CAST(close + 1 AS {P}) AS close,
         volume, 'restated' AS source, seq + 1000000000000 AS seq
  FROM feed)"""


def _silver(name: str, bronze: str) -> str:
    return f"""
{name} AS (
  SELECT symbol, dt, open, high, low, close, {CLAMPED} AS volume, seq
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, dt ORDER BY {NEWEST}) AS place
        FROM {bronze} WHERE {COMPLETE}) ranked
  WHERE place = 1)"""


def _mean(column: str, rows: int) -> str:
    return f"CAST(sum({column}) OVER last{rows} AS DOUBLE) / count({column}) OVER last{rows}"


def _gold(name: str, silver: str) -> str:
    frames = ",\n         ".join(
        f"last{n} AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (3, 5, 10, 20))
    return f"""
{name} AS (
  SELECT symbol, dt, {_mean("close", 3)} AS ma3, {_mean("close", 5)} AS ma5,
         {_mean("close", 20)} AS ma20, {_mean("volume", 10)} AS vol10,
         CAST(close - previous AS DOUBLE) / CAST(nullif(previous, 0) AS DOUBLE) AS ret1d
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS previous
        FROM {silver}) s
  WINDOW {frames})"""


FEED_SILVER = FEED + "," + _silver("feed_silver", "feed")
SILVER = BOTH + "," + _silver("silver", "bronze")
GOLD = SILVER + "," + _gold("gold", "silver")
TWO_LOADS = f"{FEED},{RESTATED},{_silver('first', 'feed')},{_silver('second', 'restated')}"
KEEP_OLD = "WHERE (symbol, dt) NOT IN (SELECT (symbol, dt) FROM {})"

TICKS = f"""{FEED},
ticks AS (SELECT symbol, ts, open AS price, {CLAMPED} AS size, seq
          FROM feed_raw WHERE symbol IS NOT NULL),
bars AS (
  SELECT symbol, CAST(ts AS DATE) AS dt, CAST(min_by(price, seq) AS {P}) AS open,
         CAST(max(price) AS {P}) AS high, CAST(min(price) AS {P}) AS low,
         CAST(max_by(price, seq) AS {P}) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks GROUP BY symbol, CAST(ts AS DATE))"""

LATEST = ("SELECT * FROM gold WHERE (symbol, dt) IN "
          "(SELECT (symbol, max(dt)) FROM gold GROUP BY symbol)")


def _check(name: str, failed: str) -> str:
    return (f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {failed}) AS n_failed, "
            "count(*) AS n_rows FROM feed")


def _side(side: str, here: str) -> str:
    return f"""
    count(*) FILTER (WHERE {here}) AS n_{side},
    CAST(sum(close) FILTER (WHERE {here}) AS DOUBLE)
      / nullif(count(close) FILTER (WHERE {here}), 0) AS mean_{side},
    round(stddev_samp(CAST(close AS DOUBLE)) FILTER (WHERE {here}), 4) AS std_{side},
    CAST(count(*) FILTER (WHERE {here} AND close IS NULL) AS DOUBLE)
      / nullif(count(*) FILTER (WHERE {here}), 0) AS null_rate_{side}"""


RECONCILE = f"""WITH {SILVER},{_silver("early", "feed")},
keys AS (SELECT DISTINCT symbol, dt FROM bronze WHERE {COMPLETE}
         UNION SELECT symbol, dt FROM silver UNION SELECT symbol, dt FROM early)
SELECT * FROM (
  SELECT symbol, dt,
         (symbol, dt) IN (SELECT (symbol, dt) FROM bronze WHERE {COMPLETE}) AS in_bronze,
         (symbol, dt) IN (SELECT (symbol, dt) FROM silver) AS in_silver,
         (symbol, dt) IN (SELECT (symbol, dt) FROM early) AS in_gold
  FROM keys) flags
WHERE NOT (in_bronze AND in_silver AND in_gold)"""

ORACLE = {
    "csv_ingest": f"WITH {BULK} SELECT {BARS}, 'csv' AS source, CAST(0 AS BIGINT) AS seq FROM bulk",
    "csv_split": f"WITH {BULK} SELECT {BARS}, 'csv' AS source, CAST(0 AS BIGINT) AS seq FROM bulk",
    "feed_ingest": f"""WITH {FEED}
SELECT symbol, dt, open, high, low, close, coalesce(volume, 0) AS volume, source, seq
FROM feed WHERE dt >= DATE '2024-01-01' AND dt < current_date""",
    "feed_extracts": f"""WITH {FEED}
SELECT symbol, dt, open, high, low, close, coalesce(volume, 0) AS volume, source, seq
FROM feed WHERE dt >= DATE '2024-01-01' AND dt < current_date""",
    "feed_single_symbol": f"""WITH {FEED}
SELECT 'ALL' AS symbol, dt, open, high, low, close, CAST(0 AS BIGINT) AS volume, source, seq
FROM feed WHERE dt >= DATE '2024-01-01' AND dt < current_date""",
    "feed_date_range": f"""WITH {FEED}
SELECT symbol, dt, open, high, low, close, coalesce(volume, 0) AS volume, source, seq
FROM feed WHERE dt >= DATE '2024-01-05' AND dt < DATE '2024-01-20'""",
    "feed_intraday_load": f"""WITH {FEED}
SELECT symbol, dt, CAST(first(open ORDER BY ts, seq) AS {P}) AS open,
       CAST(max(high) AS {P}) AS high, CAST(min(low) AS {P}) AS low,
       CAST(last(close ORDER BY ts, seq) AS {P}) AS close,
       CAST(sum({CLAMPED}) AS BIGINT) AS volume
FROM feed_raw WHERE symbol IS NOT NULL AND close IS NOT NULL AND dt >= DATE '2024-01-01'
GROUP BY symbol, dt""",
    "refresh_after_replaced_load": f"WITH {FEED_SILVER} SELECT * FROM feed_silver",
    "refresh_after_withdrawn_load": f"""WITH {TWO_LOADS}
SELECT * FROM first UNION ALL SELECT * FROM second {KEEP_OLD.format("first")}""",
    "late_correction_wins": f"""WITH {FEED_SILVER}
SELECT symbol, dt, CAST(open - 1 AS {P}) AS open, CAST(high - 1 AS {P}) AS high,
       CAST(low - 1 AS {P}) AS low, CAST(close - 1 AS {P}) AS close, volume FROM feed_silver""",
    "refresh_twice": f"WITH {FEED_SILVER},{_gold('gold', 'feed_silver')} SELECT * FROM gold",
    "load_counts": f"""WITH {BOTH}
SELECT source, count(*) AS n_rows FROM bronze GROUP BY source""",
    "bronze_union": f"WITH {BOTH} SELECT * FROM bronze",
    "bronze_append": f"""WITH {BOTH}
SELECT *, CAST(1 AS BIGINT) AS batch FROM bronze
UNION ALL SELECT *, CAST(2 AS BIGINT) AS batch FROM feed""",
    "silver_filter": f"WITH {FEED} SELECT * FROM feed WHERE {COMPLETE}",
    "quarantine": f"""WITH {FEED}
SELECT *, concat('missing: ', concat_ws(', ',
  CASE WHEN symbol IS NULL THEN 'symbol' END, CASE WHEN dt IS NULL THEN 'dt' END,
  CASE WHEN open IS NULL THEN 'open' END, CASE WHEN high IS NULL THEN 'high' END,
  CASE WHEN low IS NULL THEN 'low' END, CASE WHEN close IS NULL THEN 'close' END,
  CASE WHEN volume IS NULL THEN 'volume' END)) AS reason
FROM feed WHERE NOT ({COMPLETE})""",
    "volume_clamp": f"WITH {FEED} SELECT symbol, dt, seq, {CLAMPED} AS volume FROM feed",
    "silver_dedupe": f"""WITH {BULK}
SELECT DISTINCT ON (symbol, dt) {BARS}, seq FROM bulk ORDER BY symbol, dt, {NEWEST}""",
    "silver_build": f"WITH {SILVER} SELECT {BARS} FROM silver",
    "gold_features": f"WITH {GOLD} SELECT * FROM gold",
    "gold_features_chunked": f"WITH {GOLD} SELECT * FROM gold",
    "ma_close": f"WITH {GOLD} SELECT symbol, dt, ma3, ma5, ma20 FROM gold",
    "vol10": f"WITH {GOLD} SELECT symbol, dt, vol10 FROM gold",
    "ret1d": f"WITH {GOLD} SELECT symbol, dt, ret1d FROM gold",
    "latest_date": f"WITH {SILVER} SELECT symbol, max(dt) AS dt FROM silver GROUP BY symbol",
    "latest_features": f"""WITH {FEED},{RESTATED},
loads AS (SELECT {BRONZE} FROM feed UNION ALL SELECT {BRONZE} FROM restated),
{_silver("merged", "loads")},{_gold("gold", "merged")} {LATEST}""",
    "latest_ranked": f"WITH {GOLD} {LATEST}",
    "layer_counts": f"""WITH {GOLD}
SELECT 'bronze_price_raw' AS layer, count(*) AS n_rows FROM bronze
UNION ALL SELECT 'price_silver', count(*) FROM silver
UNION ALL SELECT 'features_gold', count(*) FROM gold""",
    "silver_upsert": f"""WITH {TWO_LOADS}
SELECT * FROM second UNION ALL SELECT * FROM first {KEEP_OLD.format("second")}""",
    "silver_upsert_bucketed": f"""WITH {TWO_LOADS}
SELECT * FROM second UNION ALL SELECT * FROM first {KEEP_OLD.format("second")}""",
    "gold_upsert": f"""WITH {TWO_LOADS},{_gold("gold1", "first")},{_gold("gold2", "second")}
SELECT * FROM gold2 UNION ALL SELECT * FROM gold1 {KEEP_OLD.format("gold2")}""",
    "medallion_gold": f"WITH {GOLD} SELECT * FROM gold",
    "incremental_gold": f"""WITH {FEED},{RESTATED},
loads AS (SELECT {BRONZE} FROM feed UNION ALL SELECT {BRONZE} FROM restated),
{_silver("merged", "loads")},{_gold("gold", "merged")} SELECT * FROM gold""",
    "daily_bars": f"WITH {TICKS} SELECT * FROM bars",
    "intraday_rollup": f"""WITH {FEED}
SELECT symbol, dt, CAST(min_by(open, seq) AS {P}) AS open, CAST(max(high) AS {P}) AS high,
       CAST(min(low) AS {P}) AS low, CAST(max_by(close, seq) AS {P}) AS close,
       CAST(sum({CLAMPED}) AS BIGINT) AS volume
FROM feed_raw WHERE {COMPLETE} GROUP BY symbol, dt""",
    "business_calendar": f"""WITH {BULK},
span AS (SELECT min(dt) AS a, max(dt) AS b FROM bulk),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS dt FROM span)
SELECT dt FROM days WHERE isodow(dt) <= 5""",
    "completeness_gaps": f"""WITH {SILVER},
span AS (SELECT symbol, min(dt) AS a, max(dt) AS b FROM silver GROUP BY symbol),
days AS (SELECT symbol, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS dt
         FROM span)
SELECT d.symbol, d.dt FROM days d LEFT JOIN silver s ON s.symbol = d.symbol AND s.dt = d.dt
WHERE isodow(d.dt) <= 5 AND s.symbol IS NULL""",
    "synth_walk": """WITH days AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey,
           l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS INTEGER) AS i,
         CAST(100 AS DOUBLE) / 3 + l_suppkey * CAST(0.5 AS DOUBLE) AS start_price,
         (l_discount - CAST(0.05 AS DOUBLE)) / 7 AS change,
         (l_tax - CAST(0.04 AS DOUBLE)) / 90 AS gap, l_quantity / 9000 AS spread
  FROM lineitem),
closed AS (
  SELECT *, start_price * product(1 + change) OVER (
           PARTITION BY symbol ORDER BY i ROWS UNBOUNDED PRECEDING) AS c
  FROM days),
opened AS (
  SELECT *, coalesce(lag(c) OVER (PARTITION BY symbol ORDER BY i) * (1 + gap), c / (1 + change)) AS o
  FROM closed)
SELECT symbol, i, CAST(round(o, 2) AS DECIMAL(18,2)) AS open,
       CAST(round(greatest(o, c) * (1 + spread), 2) AS DECIMAL(18,2)) AS high,
       CAST(round(least(o, c) * (1 - spread), 2) AS DECIMAL(18,2)) AS low,
       CAST(round(c, 2) AS DECIMAL(18,2)) AS close
FROM opened""",
    "synth_ohlcv_profile": """WITH
span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
         FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS dt FROM span),
work AS (SELECT count(*) AS n, min(dt) AS a, max(dt) AS b FROM days WHERE isodow(dt) <= 5)
SELECT concat('SYM', lpad(CAST(s_suppkey + 1 AS VARCHAR),
                          CAST(greatest(4, length(CAST(s_suppkey + 1 AS VARCHAR))) AS INTEGER), '0')) AS symbol,
       n AS n_rows, a AS first_dt, b AS last_dt, CAST(0 AS BIGINT) AS weekend_rows,
       CAST(0 AS BIGINT) AS ohlc_violations, CAST(0 AS BIGINT) AS volume_out_of_range
FROM supplier, work""",
    "quality_report": f"WITH {FEED} " + " UNION ALL ".join(
        [_check(f"{c}_is_null", f"{c} IS NULL") for c in BARS.split(", ")]
        + [_check("volume_is_negative", "volume < 0"),
           _check("ohlc_is_inconsistent", BROKEN_OHLC),
           "SELECT 'key_is_repeated', count(*) - count(DISTINCT (symbol, dt)), count(*) "
           "FROM feed"]),
    "duplicate_keys": f"""WITH {BOTH}
SELECT symbol, dt, count(*) AS n_rows FROM bronze GROUP BY symbol, dt HAVING count(*) > 1""",
    "ohlc_sanity": f"WITH {SILVER} SELECT {BARS} FROM silver WHERE {BROKEN_OHLC}",
    "drift_report": f"""WITH {BOTH},
middle AS (SELECT CAST(min(dt) + CAST(floor((max(dt) - min(dt)) / 2) AS INTEGER) AS DATE) AS d
           FROM bronze),
sides AS (SELECT symbol, {_side("ref", "dt < d")}, {_side("cur", "dt >= d")}
          FROM bronze, middle GROUP BY symbol)
SELECT *, (mean_cur - mean_ref) / nullif(mean_ref, 0) AS mean_shift FROM sides""",
    "duplicate_rate": f"""WITH {BOTH},
per_key AS (SELECT source, symbol, dt, count(*) AS copies FROM bronze GROUP BY source, symbol, dt)
SELECT source, CAST(sum(copies) AS BIGINT) AS n_rows, count(*) AS n_keys,
       CAST(sum(copies) AS DOUBLE) / count(*) AS rows_per_key
FROM per_key GROUP BY source""",
    "reconcile": RECONCILE,
    "reconcile_digest": RECONCILE,
    "reconcile_tables": f"""WITH {TWO_LOADS}
SELECT * FROM (
  SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.dt, b.dt) AS dt,
         CASE WHEN b.symbol IS NULL THEN 'only_left' WHEN a.symbol IS NULL THEN 'only_right'
              WHEN (a.open, a.high, a.low, a.close, a.volume)
                   IS DISTINCT FROM (b.open, b.high, b.low, b.close, b.volume) THEN 'changed'
              END AS status
  FROM first a FULL OUTER JOIN second b ON a.symbol = b.symbol AND a.dt = b.dt) s
WHERE status IS NOT NULL""",
    "stream_daily_bars": f"""WITH {TICKS}
SELECT * FROM bars
WHERE dt < (SELECT CAST(max(ts) - INTERVAL 2 DAY AS DATE) FROM ticks)""",
    "stream_reconcile": f"""WITH {TICKS}
SELECT CASE WHEN dt < (SELECT CAST(max(ts) - INTERVAL 2 DAY AS DATE) FROM ticks)
            THEN 'same' ELSE 'only_right' END AS status, count(*) AS n_keys
FROM bars GROUP BY 1""",
    "refresh_after_compaction": f"""WITH {FEED},{RESTATED},
loads AS (SELECT {BRONZE} FROM feed UNION ALL SELECT {BRONZE} FROM restated),
{_silver("merged", "loads")} SELECT * FROM merged""",
    "gold_from_tail": f"""WITH {BULK},{_silver("bulk_silver", "bulk")},{_gold("gold", "bulk_silver")}
SELECT * FROM gold""",
    "latest_maintained": f"""WITH {TWO_LOADS},
loads AS (SELECT {BRONZE} FROM feed UNION ALL SELECT {BRONZE} FROM restated),
{_silver("merged", "loads")},{_gold("corrected", "merged")},
left_over AS (SELECT * FROM first UNION ALL SELECT * FROM second {KEEP_OLD.format("first")}),
{_gold("withdrawn", "left_over")}
SELECT *, 'corrected' AS step FROM ({LATEST.replace("gold", "corrected")})
UNION ALL SELECT *, 'withdrawn' AS step FROM ({LATEST.replace("gold", "withdrawn")})""",
    "gate_stops_refresh": f"""WITH {FEED_SILVER}
SELECT true AS stopped, CAST(0 AS BIGINT) AS silver_rows
UNION ALL SELECT false, count(*) FROM feed_silver""",
    # Three micro-batches take the numbers 1 to 3.
    "load_states": """SELECT * FROM (VALUES
  (CAST(3 AS BIGINT), 'feed', CAST(2 AS BIGINT), 'applied'), (4, 'bulk', 4, 'applied'),
  (5, 'restated', 5, 'loaded')) AS loads(number, source, batch, state)""",
    "draw_moments": """SELECT draw, n, true AS mean_fits, true AS deviation_fits, true AS range_fits
FROM (VALUES ('change'), ('gap'), ('spread'), ('volume'), ('uniform')) AS draws(draw),
     (SELECT count(*) AS n FROM lineitem) counted""",
    "drift_sketch": f"""WITH {SILVER}
SELECT symbol, count(*) FILTER (WHERE dt < DATE '1996-01-01') AS n_ref,
       count(*) FILTER (WHERE dt >= DATE '1996-01-01') AS n_cur,
       true AS medians_fit, true AS distance_fits
FROM silver GROUP BY symbol""",
    "duplicate_rate_sketch": f"""WITH {BOTH}
SELECT source, count(*) * (CASE source WHEN 'feed' THEN 2 ELSE 1 END) AS n_rows, true AS rate_fits
FROM bronze GROUP BY source""",
    "stream_late_rows": f"""WITH {TICKS},
marks AS (SELECT CAST(max(ts) FILTER (WHERE seq % 2 = 0) - INTERVAL 2 DAY AS DATE) AS first,
                 CAST(max(ts) - INTERVAL 2 DAY AS DATE) AS last FROM ticks),
days AS (SELECT symbol, CAST(ts AS DATE) AS dt, seq % 2 = 1 AND CAST(ts AS DATE) < first AS late, last
         FROM ticks, marks)
SELECT 'bars' AS kind, count(DISTINCT (symbol, dt)) AS n FROM days WHERE NOT late AND dt < last
UNION ALL SELECT 'late_rows', count(*) FROM days WHERE late
UNION ALL SELECT 'open_rows', count(*) FROM days WHERE NOT late AND dt >= last""",
    "stream_redelivery": f"""WITH {FEED_SILVER}
SELECT 'bronze_price_raw' AS layer, count(*) AS n_rows FROM feed
UNION ALL SELECT 'price_silver', count(*) FROM feed_silver""",
    "topic_gold": f"WITH {FEED_SILVER},{_gold('gold', 'feed_silver')} SELECT * FROM gold",
    "stream_silver": f"WITH {FEED_SILVER} SELECT * FROM feed_silver",
    "stream_gold": f"WITH {FEED_SILVER},{_gold('gold', 'feed_silver')} SELECT * FROM gold",
}
