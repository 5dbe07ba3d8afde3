"""The registered queries once more, as SQL for an independent engine."""

from __future__ import annotations


def half_up(value: str, digits: int) -> str:
    """Round halves away from zero on the decimal text of a double."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def mean(value: str, scale: str = "1000000") -> str:
    """Mean over an exact sum of millionths."""
    return f"CAST(sum(CAST(round({value} * {scale}) AS HUGEINT)) AS DOUBLE) / (count({value}) * {scale})"


TICKS = """
p AS (
  SELECT event_id, event_type AS symbol, ts,
         CASE WHEN event_id % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events),
o AS (
  SELECT *, coalesce(lag(price) OVER (PARTITION BY symbol ORDER BY ts, event_id), price) AS open FROM p),
ticks AS (
  SELECT event_id, symbol, price, open,
         CASE WHEN event_id % 97 = 0 THEN least(price, open) - 1 ELSE greatest(price, open) END AS high,
         CASE WHEN event_id % 97 = 0 THEN greatest(price, open) ELSE least(price, open) END AS low,
         volume, date_trunc('minute', ts) AS "timestamp", ts AS ingestion_timestamp
  FROM o)"""

BRONZE = f"""{TICKS},
bronze AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY symbol, "timestamp" ORDER BY ingestion_timestamp, event_id) AS nth
    FROM ticks) WHERE nth = 1)"""

SILVER = f"""{BRONZE},
silver AS (
  SELECT *, high - low AS spread, price - open AS price_change,
         CASE WHEN open > 0 THEN (price - open) / open * 100 ELSE 0.0 END AS price_change_pct,
         coalesce(volume = 0 OR price <= 0 OR open <= 0 OR high < low, false) AS is_anomaly
  FROM bronze)"""

CANDLE_COLUMNS = f"""
         {half_up(mean("price"), 2)} AS avg_price,
         {half_up("min(price)", 2)} AS min_price,
         {half_up("max(price)", 2)} AS max_price,
         {half_up("coalesce(stddev_samp(price), 0.0)", 4)} AS volatility,
         CAST(sum(volume) AS BIGINT) AS total_volume,
         count(*) AS trade_count,
         {half_up(mean(half_up("price_change_pct", 10), "10000000000"), 2)} AS avg_price_change_pct"""


def gold(width: str) -> str:
    return f"""{SILVER},
gold AS (
  SELECT time_bucket(INTERVAL '{width}', "timestamp") AS window_start,
         time_bucket(INTERVAL '{width}', "timestamp") + INTERVAL '{width}' AS window_end,
         symbol, {CANDLE_COLUMNS}
  FROM silver WHERE NOT is_anomaly GROUP BY 1, 2, 3)"""


HOUR = gold("1 hour")

SLIDING = f"""{SILVER},
shifted AS (
  SELECT *, time_bucket(INTERVAL '30 minutes', "timestamp") AS window_start FROM silver
  UNION ALL
  SELECT *, time_bucket(INTERVAL '30 minutes', "timestamp") - INTERVAL '30 minutes' FROM silver),
gold AS (
  SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, symbol, {CANDLE_COLUMNS}
  FROM shifted WHERE NOT is_anomaly GROUP BY 1, 2, 3)"""

FEATURES = f"""{HOUR},
before AS (
  SELECT * REPLACE (coalesce(volatility, 0.0) AS volatility),
         lag(avg_price) OVER (PARTITION BY symbol ORDER BY window_start) AS prev_price
  FROM gold),
features AS (
  SELECT *, ln(avg_price / prev_price) AS log_returns, ln(total_volume + 1.0) AS log_volume
  FROM before
  WHERE prev_price <> 0 AND avg_price / prev_price > 0 AND total_volume + 1.0 > 0)"""

LABELS = f"""{FEATURES},
ahead AS (
  SELECT *, lead(avg_price) OVER (PARTITION BY symbol ORDER BY window_start) AS next_price FROM features),
labelled AS (
  SELECT *, CASE WHEN next_price > avg_price THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM ahead
  WHERE COLUMNS(*) IS NOT NULL)"""

SPLIT = f"""{LABELS},
ranked AS (
  SELECT *, percent_rank() OVER (PARTITION BY symbol ORDER BY window_start) AS rank FROM labelled),
split AS (
  SELECT *, CASE WHEN rank <= 0.8 THEN 'train' ELSE 'test' END AS split FROM ranked)"""

BAND = "CASE WHEN probability > 0.55 THEN 'BUY' WHEN probability < 0.45 THEN 'SELL' ELSE 'HOLD' END"

PREDICTIONS = f"""{HOUR},
chance AS (
  SELECT symbol, window_start, window_end, total_volume,
         CAST((trade_count * 37 + total_volume * 11) % 101 AS DOUBLE) / 100.0 AS probability
  FROM gold),
predictions AS (
  SELECT symbol, window_start, window_end, probability,
         CASE WHEN total_volume % 7 = 1 THEN 'WAIT' WHEN total_volume % 7 > 1 THEN {BAND} END AS signal
  FROM chance)"""

SHOWN = """CASE WHEN coalesce(signal, 'WAIT') <> 'WAIT' THEN signal WHEN probability > 0.5 THEN 'BUY'
              WHEN probability > 0 THEN 'SELL' ELSE 'WAIT' END"""

LOGS = f"""* REPLACE ({half_up("log_returns", 10)} AS log_returns, {half_up("log_volume", 10)} AS log_volume)"""

NO_REPEATS = f"""WITH {TICKS}
SELECT * EXCLUDE (previous) FROM (
  SELECT *, lag("timestamp") OVER (PARTITION BY symbol ORDER BY ingestion_timestamp, event_id) AS previous
  FROM ticks) WHERE "timestamp" IS DISTINCT FROM previous"""

GOLD_HOUR = f"WITH {HOUR} SELECT * FROM gold"

LATEST_FEATURES = f"""WITH {FEATURES}
SELECT {LOGS} FROM features QUALIFY rank() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1"""

ORACLE: dict[str, str] = {
    "bronze_dedup": f"WITH {BRONZE} SELECT * FROM bronze",
    "repeat_suppression": NO_REPEATS,
    "stream_repeats": NO_REPEATS,
    "duplicate_audit": f"""WITH {TICKS}
SELECT symbol, "timestamp", count(*) AS "count" FROM ticks GROUP BY ALL HAVING count(*) > 1""",
    "worst_duplicates": f"""WITH {TICKS}
SELECT symbol, "timestamp", count(*) AS "count" FROM ticks GROUP BY ALL HAVING count(*) > 1
ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "duplicate_summary": f"""WITH {TICKS}, n AS (SELECT count(*) AS n FROM ticks GROUP BY symbol, "timestamp")
SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) FILTER (n > 1) AS duplicate_keys FROM n""",
    "bronze_sample": f"""WITH {BRONZE} SELECT * FROM bronze ORDER BY symbol, "timestamp" LIMIT 5""",
    "silver_enrich": f"""WITH {SILVER}
SELECT * REPLACE ({half_up("price_change_pct", 10)} AS price_change_pct) FROM silver""",
    "gold_candles_hour": GOLD_HOUR,
    "layer_tables": GOLD_HOUR,
    "mixed_writes": GOLD_HOUR,
    "stream_crash": GOLD_HOUR,
    "candles_from_states": GOLD_HOUR,
    "sliding_candles_from_states": f"WITH {SLIDING} SELECT * FROM gold",
    "stream_backlog": GOLD_HOUR,
    "stream_ordered": f"""WITH {TICKS}
SELECT * EXCLUDE (event_id) FROM ticks QUALIFY row_number() OVER (
  PARTITION BY symbol, "timestamp" ORDER BY ingestion_timestamp, price, open, high, low, volume) = 1""",
    "stream_balance": f"""WITH {TICKS},
later AS (SELECT * FROM ticks WHERE "timestamp" >= TIMESTAMP '2024-01-15'),
kept AS (
  SELECT coalesce(volume = 0 OR price <= 0 OR open <= 0 OR high < low, false) AS is_anomaly FROM later
  QUALIFY row_number() OVER (
    PARTITION BY symbol, "timestamp" ORDER BY ingestion_timestamp, price, open, high, low, volume) = 1)
SELECT 'candles' AS outcome, count(*) FILTER (NOT is_anomaly) AS messages FROM kept
UNION ALL SELECT 'anomalies', count(*) FILTER (is_anomaly) FROM kept
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM later) - (SELECT count(*) FROM kept)
UNION ALL SELECT 'late', count(*) FROM ticks WHERE "timestamp" < TIMESTAMP '2024-01-15'
UNION ALL SELECT 'rejects', count(*) FROM later WHERE event_id % 10 = 0
UNION ALL SELECT 'late for candles', 0
UNION ALL SELECT 'open windows', 1""",
    "compacted_candles": f"{GOLD_HOUR} WHERE window_start >= TIMESTAMP '2024-01-08' AND window_start < TIMESTAMP '2024-01-15'",
    "table_columns": f"""WITH {HOUR}, n AS (SELECT count(*) AS filled FROM gold)
SELECT col_name, data_type, filled FROM n, (VALUES
  ('window_start', 'timestamp'), ('window_end', 'timestamp'), ('symbol', 'string'), ('avg_price', 'double'), ('min_price', 'double'),
  ('max_price', 'double'), ('volatility', 'double'), ('total_volume', 'bigint'), ('trade_count', 'bigint'),
  ('avg_price_change_pct', 'double'), ('gold_computed_at', 'timestamp')) AS c (col_name, data_type)""",
    "silver_text_times": f"""WITH {SILVER}
SELECT * REPLACE ({half_up("price_change_pct", 10)} AS price_change_pct) FROM silver""",
    "sql_over_views": f"""WITH {HOUR}
SELECT symbol, count(*) AS windows, max(max_price) AS high FROM gold WHERE trade_count >= 2 GROUP BY symbol""",
    "stream_scoring": f"""WITH {FEATURES}
SELECT symbol, window_start, window_end FROM features
QUALIFY rank() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""",
    "rf_signals": f"""WITH {FEATURES}
SELECT symbol, window_start, window_end, true AS is_probability, true AS signal_is_band FROM features
QUALIFY rank() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""",
    "rf_by_joins": f"""WITH {SPLIT} SELECT symbol, window_start, true AS agrees FROM split WHERE split = 'test'""",
    "rf_accuracy": f"""WITH {SPLIT}
SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
       true AS accuracy_is_reported FROM split""",
    "stream_gold": GOLD_HOUR,
    "gold_candles_10s": f"WITH {gold('10 seconds')} SELECT * FROM gold",
    "gold_candles_sliding": f"WITH {SLIDING} SELECT * FROM gold",
    "symbol_stats": f"""WITH {HOUR}
SELECT symbol, {mean("avg_price")} AS overall_avg_price, {mean("volatility")} AS avg_volatility,
       CAST(sum(total_volume) AS BIGINT) AS cumulative_volume, count(*) AS window_count
FROM gold GROUP BY symbol""",
    "volatility_overview": f"""WITH {HOUR}
SELECT symbol, {mean("avg_price")} AS mean_price, max(volatility) AS max_vol,
       CAST(sum(total_volume) AS BIGINT) AS total_vol
FROM gold GROUP BY symbol""",
    "default_playground": f"""WITH {HOUR}
SELECT symbol, {half_up("avg(avg_price)", 6)} AS mean_price, max(volatility) AS max_vol,
       CAST(sum(total_volume) AS BIGINT) AS total_vol
FROM gold GROUP BY symbol""",
    "top_movers": f"""WITH {HOUR}
SELECT symbol, window_start, window_end, avg_price_change_pct, avg_price
FROM gold WHERE abs(avg_price_change_pct) > 1.0
ORDER BY abs(avg_price_change_pct) DESC, symbol, window_start LIMIT 10""",
    "volatile_windows": f"""WITH {HOUR}
SELECT symbol, window_start, volatility, avg_price FROM gold WHERE volatility > 2.0""",
    "latest_n_windows": f"""WITH {HOUR}
SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) <= 100""",
    "latest_windows_of_symbol": f"""WITH {HOUR}
SELECT * FROM gold WHERE symbol = 'click' ORDER BY window_end DESC LIMIT 100""",
    "distinct_symbols": f"WITH {HOUR} SELECT DISTINCT symbol FROM gold",
    "session_range": f"""WITH {HOUR}
SELECT symbol, max(max_price) AS session_high, min(min_price) AS session_low FROM gold GROUP BY symbol""",
    "price_series": f"""WITH {HOUR}
SELECT symbol, window_end AS "time", avg_price AS open, max_price AS high, min_price AS low,
       avg_price AS "close",
       CAST(greatest(coalesce(total_volume - lag(total_volume) OVER (
         PARTITION BY symbol ORDER BY window_start), 0), 0) AS BIGINT) AS volume_delta
FROM gold""",
    "price_series_of_symbol": f"""WITH {HOUR}
SELECT symbol, window_end AS "time", avg_price AS open, max_price AS high, min_price AS low,
       avg_price AS "close",
       CAST(greatest(coalesce(total_volume - lag(total_volume) OVER (
         PARTITION BY symbol ORDER BY window_start), 0), 0) AS BIGINT) AS volume_delta
FROM gold WHERE symbol = 'click'""",
    "trend_ma5": f"""WITH {HOUR},
moving AS (
  SELECT symbol, window_start, avg_price AS latest_price,
         CAST(sum(CAST(round(avg_price * 1000000) AS HUGEINT)) OVER w AS DOUBLE)
           / (count(*) OVER w * 1000000) AS mean_price,
         row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS nth
  FROM gold
  WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT symbol, window_start, latest_price, {half_up("mean_price", 6)} AS mean_price,
       CASE WHEN latest_price > mean_price THEN 'Bullish' ELSE 'Bearish' END AS trend
FROM moving WHERE nth = 1""",
    "trend_series": f"""WITH {HOUR},
moving AS (
  SELECT symbol, window_start, avg_price AS latest_price,
         CAST(sum(CAST(round(avg_price * 1000000) AS HUGEINT)) OVER w AS DOUBLE)
           / (count(*) OVER w * 1000000) AS mean_price
  FROM gold
  WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT symbol, window_start, latest_price, {half_up("mean_price", 6)} AS mean_price,
       CASE WHEN latest_price > mean_price THEN 'Bullish' ELSE 'Bearish' END AS trend
FROM moving""",
    "latest_many_ticks": f"""WITH {SILVER}
SELECT * EXCLUDE (price_change_pct) FROM silver
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= 1500""",
    "risk_flags": f"""WITH {HOUR}
SELECT symbol, window_start, volatility,
       CASE WHEN volatility > 1.0 THEN 'High Risk' ELSE 'Stable' END AS risk,
       {half_up("max_price - min_price", 6)} AS window_spread
FROM gold""",
    "signal_bands": f"""WITH {PREDICTIONS}
SELECT symbol, window_start, probability, {BAND} AS band, {SHOWN} AS shown, probability > 0.6 AS strong
FROM predictions""",
    "latest_prediction": f"""WITH {PREDICTIONS}
SELECT symbol, window_end, probability, signal FROM predictions
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1""",
    "kpi_board": f"""WITH {PREDICTIONS},
numbered AS (
  SELECT *, row_number() OVER w AS nth,
         max(max_price) OVER (PARTITION BY symbol) AS session_high,
         min(min_price) OVER (PARTITION BY symbol) AS session_low
  FROM gold WINDOW w AS (PARTITION BY symbol ORDER BY window_start DESC)),
recent AS (
  SELECT symbol, {mean("avg_price")} AS mean_price FROM numbered WHERE nth <= 5 GROUP BY symbol)
SELECT n.symbol, n.window_end, n.avg_price AS price, n.avg_price_change_pct AS change_pct,
       {SHOWN} AS signal, probability, probability > 0.6 AS strong, n.total_volume AS volume, volatility,
       CASE WHEN volatility > 1.0 THEN 'High Risk' ELSE 'Stable' END AS risk,
       session_high, session_low, {half_up("max_price - min_price", 6)} AS window_spread,
       CASE WHEN avg_price > mean_price THEN 'Bullish' ELSE 'Bearish' END AS trend
FROM numbered n JOIN recent USING (symbol)
JOIN predictions p ON p.symbol = n.symbol AND p.window_start = n.window_start
WHERE nth = 1""",
    "feature_rows": f"WITH {FEATURES} SELECT {LOGS} FROM features",
    "label_rows": f"WITH {LABELS} SELECT {LOGS} FROM labelled",
    "time_split": f"""WITH {SPLIT} SELECT symbol, window_start, label, rank, split FROM split""",
    "split_counts": f"WITH {SPLIT} SELECT split, count(*) AS row_count FROM split GROUP BY split",
    "latest_per_symbol": LATEST_FEATURES,
    "latest_per_symbol_join": LATEST_FEATURES,
    "feature_file_scan": f"""WITH {LABELS}
SELECT CAST(avg_price AS FLOAT) AS price_feature, CAST(volatility AS FLOAT) AS volatility_feature,
       CAST(label AS FLOAT) AS target
FROM labelled""",
    "json_roundtrip": f"WITH {TICKS} SELECT * EXCLUDE (event_id) FROM ticks",
    "rejected_messages": f"""WITH {TICKS},
damaged AS (
  SELECT event_id AS n, ingestion_timestamp FROM ticks WHERE event_id % 10 < 3)
SELECT CASE n % 10 WHEN 0 THEN '~' || n WHEN 1 THEN '{{"timestamp":' || n || '}}'
                   ELSE '{{"symbol":"s' || n || '"}}' END AS value,
       ingestion_timestamp,
       CASE n % 10 WHEN 0 THEN 'not_json' WHEN 1 THEN 'no_symbol' ELSE 'no_timestamp' END AS reason
FROM damaged""",
    "payload_series": f"""WITH {TICKS}
SELECT symbol, price, open, high, low, volume, "timestamp", 'alpha_vantage' AS source
FROM ticks WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""",
    "payload_quotes": f"""WITH {TICKS}
SELECT symbol,
       CASE event_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN NULL ELSE 'EUR' END AS currency,
       CASE WHEN event_id % 3 > 0 THEN 'XPAR' ELSE 'UNKNOWN' END AS exchange,
       CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE price END AS price,
       CASE WHEN event_id % 11 > 0 THEN open ELSE 0.0 END AS open,
       high, low,
       CASE WHEN event_id % 2 = 0 AND volume <> 0 THEN volume ELSE volume + 1 END AS volume,
       CAST(0 AS BIGINT) AS market_cap, "timestamp"
FROM ticks""",
}
