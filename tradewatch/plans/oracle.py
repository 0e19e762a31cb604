"""DuckDB SQL equivalent to each registered query (same column names).

the Spark code: it is the independent check of the Spark plans.
"""

from __future__ import annotations

SPARSE = """
SELECT event_id AS trade_id, value AS price, 1.0::DOUBLE + user_id % 10 AS qty, ts AS trade_time,
       user_id % 2 = 0 AS is_buyer_maker, user_id % 2 = 1 AS is_sell,
       (1.0::DOUBLE + user_id % 10) * value AS usd_value, CAST(ts AS DATE) AS trade_date
FROM events"""

DENSE = """
SELECT event_id AS trade_id, 1.0::DOUBLE + value / 100000 AS price, 100.0::DOUBLE + user_id % 20 AS qty,
       1704153589999400 + (event_id // 5) * 100000 + event_id % 5 * 300 AS time,
       user_id % 2 = 1 AS is_sell,
       CAST(make_timestamp(1704153589999400 + (event_id // 5) * 100000 + event_id % 5 * 300) AS DATE) AS trade_date
FROM events"""

DIRTY = """
SELECT * FROM (
  SELECT event_id AS trade_id,
         CASE WHEN event_id % 500 = 0 THEN NULL WHEN event_id % 500 = 1 THEN -value ELSE value END AS price,
         CASE WHEN event_id % 400 = 2 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE + user_id % 10 END AS qty,
         CASE WHEN event_id % 200 = 7 THEN ts + INTERVAL 1 DAY ELSE ts END AS trade_time,
         CASE WHEN event_id % 300 = 3 THEN NULL ELSE user_id % 2 = 0 END AS is_buyer_maker,
         CAST(ts AS DATE) AS trade_date
  FROM events) b
UNION ALL
SELECT * FROM (
  SELECT event_id AS trade_id,
         CASE WHEN event_id % 500 = 0 THEN NULL WHEN event_id % 500 = 1 THEN -value ELSE value END AS price,
         CASE WHEN event_id % 400 = 2 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE + user_id % 10 END AS qty,
         CASE WHEN event_id % 200 = 7 THEN ts + INTERVAL 1 DAY ELSE ts END AS trade_time,
         CASE WHEN event_id % 300 = 3 THEN NULL ELSE user_id % 2 = 0 END AS is_buyer_maker,
         CAST(ts AS DATE) AS trade_date
  FROM events) b2 WHERE trade_id % 100 = 50"""

# Silver rows of the dirty bronze: filters F1-F3, one row per (day, trade_id).
SILVER = f"""
WITH b AS ({DIRTY}),
f AS (SELECT * FROM b WHERE price > 0 AND qty > 0 AND CAST(trade_time AS DATE) = trade_date),
d AS (SELECT *, row_number() OVER (PARTITION BY trade_date, trade_id
                                   ORDER BY trade_time NULLS FIRST, price NULLS FIRST, qty NULLS FIRST, is_buyer_maker NULLS FIRST) AS rn
      FROM f)
SELECT trade_id, price, qty, price * qty AS quote_qty, epoch_us(trade_time) AS time, is_buyer_maker,
       true AS is_best_match, trade_time, CAST(hour(trade_time) AS INTEGER) AS trade_hour,
       CAST(minute(trade_time) AS INTEGER) AS trade_minute, NOT is_buyer_maker AS is_sell,
       qty * price AS usd_value, trade_date AS processed_date
FROM d WHERE rn = 1"""

CANDLES = f"""
WITH t AS ({SPARSE}),
w AS (SELECT *, make_timestamp((epoch_us(trade_time) // 300000000) * 300000000) AS window_start FROM t)
SELECT CAST(window_start AS DATE) AS trade_date, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       first(price ORDER BY trade_time, trade_id NULLS FIRST, price) AS open, max(price) AS high, min(price) AS low,
       last(price ORDER BY trade_time, trade_id NULLS FIRST, price) AS close, sum(qty) AS volume_pepe, sum(usd_value) AS volume_usdt,
       count(trade_id) AS trade_count,
       count(CASE WHEN NOT is_sell THEN trade_id END) AS buyer_initiated_count,
       count(CASE WHEN is_sell THEN trade_id END) AS seller_initiated_count,
       count(CASE WHEN NOT is_sell THEN trade_id END) / count(trade_id) AS buy_sell_ratio
FROM w GROUP BY window_start"""

FEATURES = f"""
WITH c AS ({CANDLES}),
l AS (SELECT *, lag(close) OVER (PARTITION BY trade_date ORDER BY window_start) AS prev_close,
             avg(volume_usdt) OVER (PARTITION BY trade_date ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS avg_volume,
             row_number() OVER (PARTITION BY trade_date ORDER BY window_start) AS row_num,
             min(close) OVER (PARTITION BY trade_date ORDER BY window_start ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS lookahead_min_close
      FROM c)
SELECT *, CASE WHEN prev_close IS NOT NULL AND prev_close > 0 THEN (close - prev_close) / prev_close * 100 END AS pct_change
FROM l"""

PUMPS = f"SELECT * FROM ({FEATURES}) x WHERE pct_change >= 10 AND volume_usdt >= avg_volume * 2.5"

EVENTS = f"""
WITH p AS ({PUMPS}),
e AS (SELECT window_start AS pump_window_start, window_end AS pump_window_end, prev_close AS price_at_pump_start,
             close AS price_at_peak, lookahead_min_close AS price_after_dump, pct_change AS pump_pct,
             (lookahead_min_close - close) / close * 100 AS dump_pct, volume_usdt AS volume_usdt_during_pump,
             pct_change AS estimated_profit_pct,
             CASE WHEN pct_change >= 20 THEN 'HIGH' WHEN pct_change >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
             trade_date, trade_date AS processed_date
      FROM p)
SELECT * FROM e WHERE dump_pct <= -7"""


def _wash(divisor: int, exact: bool, min_score: float | None) -> str:
    same = "true" if exact else "b.time // 1000000 = s.time // 1000000"
    band = 1000 * divisor
    score = "" if min_score is None else f"WHERE wash_score >= {min_score}"
    return f"""
WITH t AS ({DENSE}),
p AS (SELECT b.trade_date, b.trade_id AS buy_trade_id, s.trade_id AS sell_trade_id, abs(b.time - s.time) AS dt,
             abs(b.time - s.time) / {divisor} AS td,
             abs(b.price - s.price) / b.price * 100 AS price_diff_pct,
             (1 - abs(b.qty - s.qty) / b.qty) * 100 AS qty_similarity_pct
      FROM t b JOIN t s ON {same}
                       AND s.time > b.time - {band} AND s.time < b.time + {band}
      WHERE NOT b.is_sell AND s.is_sell),
c AS (SELECT *, (1 - td / 1000) * 0.4 + (1 - price_diff_pct / 0.1) * 0.35 + (qty_similarity_pct / 100) * 0.25 AS wash_score
      FROM p WHERE td < 1000 AND price_diff_pct < 0.1 AND qty_similarity_pct > 90)
SELECT trade_date, buy_trade_id, sell_trade_id, dt // {divisor} AS time_diff_ms, price_diff_pct, qty_similarity_pct,
       wash_score, trade_date AS processed_date
FROM c {score}"""


def _round(cols: list[str], rounded: set[str], src: str) -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in rounded else c for c in cols)
    return f"SELECT {sel} FROM ({src}) q"


WASH_COLS = ["trade_date", "buy_trade_id", "sell_trade_id", "time_diff_ms", "price_diff_pct", "qty_similarity_pct", "wash_score", "processed_date"]
WASH_R = {"price_diff_pct", "qty_similarity_pct", "wash_score"}
EVENT_COLS = ["pump_window_start", "pump_window_end", "price_at_pump_start", "price_at_peak", "price_after_dump", "pump_pct",
              "dump_pct", "volume_usdt_during_pump", "estimated_profit_pct", "severity", "trade_date", "processed_date"]

DIM_SPAN = f"""
WITH s AS (SELECT min(trade_date) AS lo, max(trade_date) AS hi FROM ({SPARSE}) t),
d AS (SELECT CAST(g AS DATE) AS full_date FROM s, generate_series(s.lo::TIMESTAMP, s.hi::TIMESTAMP, INTERVAL 1 DAY) AS gs(g))"""

DIM_COLS = """CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_id, full_date,
       CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
       CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
       isodow(full_date) - 1 >= 5 AS is_weekend"""

FACT_TRADES = f"""
SELECT trade_id, CAST(year(processed_date) * 10000 + month(processed_date) * 100 + day(processed_date) AS INTEGER) AS date_id,
       CAST(CAST(price AS DECIMAL(20,10)) AS DOUBLE) AS price, CAST(CAST(qty AS DECIMAL(20,8)) AS DOUBLE) AS qty,
       CAST(CAST(quote_qty AS DECIMAL(20,8)) AS DOUBLE) AS quote_qty, trade_time, is_buyer_maker, is_sell,
       CAST(CAST(usd_value AS DECIMAL(20,8)) AS DOUBLE) AS usd_value, trade_hour, processed_date
FROM ({SILVER}) s"""

WASH_J1 = _wash(1, False, 0.8)

# Silver with contract violations: ids that come again a day later, prices too large for the warehouse.
VIOLATED = f"""
SELECT trade_id, CASE WHEN trade_id % 700 = 5 THEN NULL ELSE price END AS price, is_buyer_maker, is_sell, processed_date FROM ({SILVER}) s
UNION ALL
SELECT trade_id, price, is_buyer_maker, is_sell, processed_date + 1 FROM ({SILVER}) s WHERE trade_id % 90 = 11"""

# Trades of two symbols that share ids and days: the second at twice the price and half the quantity.
TWO_SYMBOLS = f"""
SELECT *, 'AAAUSDT' AS symbol FROM ({SPARSE}) a
UNION ALL
SELECT trade_id, price * 2, qty / 2, trade_time, is_buyer_maker, is_sell, usd_value, trade_date, 'BBBUSDT'
FROM ({SPARSE}) b WHERE trade_id % 3 <> 0"""


def _count(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


ORACLE: dict[str, str] = {
    "clean_trades": SILVER,
    "clean_step_counts": f"""
WITH b AS ({DIRTY}),
f AS (SELECT *, coalesce(price > 0, false) AS p_ok, coalesce(qty > 0, false) AS q_ok,
             coalesce(CAST(trade_time AS DATE) = trade_date, false) AS d_ok FROM b)
SELECT trade_date, {_count('count(*)')} AS total_rows, {_count('count_if(NOT p_ok)')} AS removed_price,
       {_count('count_if(p_ok AND NOT q_ok)')} AS removed_qty, {_count('count_if(p_ok AND q_ok AND NOT d_ok)')} AS removed_date,
       {_count("count_if(p_ok AND q_ok AND d_ok) - count(DISTINCT CASE WHEN p_ok AND q_ok AND d_ok THEN coalesce(CAST(trade_id AS VARCHAR), '<null>') END)")} AS removed_duplicates,
       {_count("count(DISTINCT CASE WHEN p_ok AND q_ok AND d_ok THEN coalesce(CAST(trade_id AS VARCHAR), '<null>') END)")} AS rows_out
FROM f GROUP BY trade_date""",
    "dedup_trades": f"""
WITH b AS ({DIRTY}),
d AS (SELECT *, row_number() OVER (PARTITION BY trade_date, trade_id
                                   ORDER BY trade_time NULLS FIRST, price NULLS FIRST, qty NULLS FIRST, is_buyer_maker NULLS FIRST) AS rn,
             count(*) OVER (PARTITION BY trade_date, trade_id) AS copies
      FROM b)
SELECT trade_date, trade_id, price, qty, trade_time, is_buyer_maker, copies FROM d WHERE rn = 1""",
    "time_enrichment": f"""
SELECT trade_id, epoch_us(trade_time) AS time, make_timestamp(epoch_us(trade_time)) AS trade_time,
       CAST(hour(trade_time) AS INTEGER) AS trade_hour, CAST(minute(trade_time) AS INTEGER) AS trade_minute,
       NOT is_buyer_maker AS is_sell, qty * price AS usd_value
FROM ({SPARSE}) t""",
    "dq_report": f"""
WITH b AS ({DIRTY}),
a AS (SELECT trade_date, {_count('count(*)')} AS total_rows,
             {_count('count_if(price IS NULL OR price <= 0)')} AS invalid_prices,
             {_count('count_if(qty IS NULL OR qty <= 0)')} AS invalid_qty,
             {_count('count_if(trade_time IS NULL OR CAST(trade_time AS DATE) <> trade_date)')} AS out_of_range_timestamps,
             {_count("count(*) - count(DISTINCT coalesce(CAST(trade_id AS VARCHAR), '<null>'))")} AS duplicate_trade_ids
      FROM b GROUP BY trade_date),
r AS (SELECT *, total_rows >= 100000 AS row_count_ok, invalid_prices / total_rows AS invalid_price_rate,
             invalid_qty / total_rows AS invalid_qty_rate, out_of_range_timestamps / total_rows AS out_of_range_rate FROM a)
SELECT trade_date, total_rows, row_count_ok, invalid_prices, invalid_qty, out_of_range_timestamps, duplicate_trade_ids,
       invalid_price_rate, invalid_qty_rate, out_of_range_rate,
       total_rows > 0 AND invalid_price_rate <= 0.01 AND invalid_qty_rate <= 0.01 AND out_of_range_rate <= 0.05 AS passed
FROM r""",
    "ohlcv_5min": _round(
        ["trade_date", "window_start", "window_end", "open", "high", "low", "close", "volume_pepe", "volume_usdt",
         "trade_count", "buyer_initiated_count", "seller_initiated_count", "buy_sell_ratio"],
        {"volume_pepe", "volume_usdt", "buy_sell_ratio"}, CANDLES),
    "side_counts": f"""
WITH b AS ({DIRTY}),
w AS (SELECT *, NOT is_buyer_maker AS is_sell,
             make_timestamp((epoch_us(trade_time) // 300000000) * 300000000) AS window_start FROM b)
SELECT CAST(window_start AS DATE) AS trade_date, window_start, count(trade_id) AS trade_count,
       count(CASE WHEN NOT is_sell THEN trade_id END) AS buyer_initiated_count,
       count(CASE WHEN is_sell THEN trade_id END) AS seller_initiated_count,
       round(count(CASE WHEN NOT is_sell THEN trade_id END) / count(trade_id), 6) AS buy_sell_ratio
FROM w GROUP BY window_start""",
    "candle_change": f"SELECT trade_date, window_start, close, prev_close, round(pct_change, 6) AS pct_change FROM ({FEATURES}) f",
    "rolling_volume": f"SELECT trade_date, window_start, round(volume_usdt, 6) AS volume_usdt, round(avg_volume, 6) AS avg_volume FROM ({FEATURES}) f",
    "pump_candles": f"""SELECT trade_date, window_start, close, prev_close, round(pct_change, 6) AS pct_change,
       round(volume_usdt, 6) AS volume_usdt, round(avg_volume, 6) AS avg_volume FROM ({PUMPS}) p""",
    "lookahead_min": f"SELECT trade_date, window_start, close, lookahead_min_close FROM ({FEATURES}) f",
    "lookahead_join": f"""
WITH f AS ({FEATURES}), p AS (SELECT * FROM f WHERE pct_change >= 10 AND volume_usdt >= avg_volume * 2.5)
SELECT p.trade_date, p.window_start, p.close, round(p.pct_change, 6) AS pct_change, min(c.close) AS price_after_dump
FROM p JOIN f c ON c.trade_date = p.trade_date AND c.row_num > p.row_num AND c.row_num <= p.row_num + 12
GROUP BY p.trade_date, p.window_start, p.close, p.pct_change""",
    "pump_dump_events": _round(EVENT_COLS, {"pump_pct", "dump_pct", "volume_usdt_during_pump", "estimated_profit_pct"}, EVENTS),
    "severity_counts": f"SELECT trade_date, severity, count(*) AS events FROM ({EVENTS}) e GROUP BY trade_date, severity",
    "wash_candidates": _round(WASH_COLS, WASH_R, _wash(1, False, None)),
    "wash_pairs": _round(WASH_COLS, WASH_R, WASH_J1),
    "wash_pairs_documented_unit": _round(WASH_COLS, WASH_R, _wash(1000, False, 0.8)),
    "wash_pairs_exact": _round(WASH_COLS, WASH_R, _wash(1, True, 0.8)),
    "wash_pairs_exact_documented_unit": _round(WASH_COLS, WASH_R, _wash(1000, True, 0.8)),
    "wash_tiers": f"""
SELECT trade_date, 1 AS time_unit_divisor, count(*) AS pairs, CAST(count_if(wash_score >= 0.95) AS BIGINT) AS high_confidence_pairs
FROM ({_wash(1, False, 0.8)}) a GROUP BY trade_date
UNION ALL
SELECT trade_date, 1000 AS time_unit_divisor, count(*) AS pairs, CAST(count_if(wash_score >= 0.95) AS BIGINT) AS high_confidence_pairs
FROM ({_wash(1000, False, 0.8)}) b GROUP BY trade_date""",
    "dim_date": f"{DIM_SPAN} SELECT {DIM_COLS} FROM d",
    "dim_date_upsert": f"""
WITH e AS (SELECT DISTINCT trade_date AS full_date FROM ({SPARSE}) t),
n AS (SELECT DISTINCT CAST(trade_time AS DATE) AS full_date FROM ({DIRTY}) b WHERE trade_time IS NOT NULL)
SELECT {DIM_COLS} FROM n WHERE full_date NOT IN (SELECT full_date FROM e)""",
    "dim_time_window": f"""
WITH d AS (SELECT DISTINCT trade_date AS d FROM ({SPARSE}) t),
s AS (SELECT d, slot FROM d, range(0, 288) AS r(slot))
SELECT CAST((year(d) * 10000 + month(d) * 100 + day(d)) AS BIGINT) * 1000 + slot AS window_id,
       CAST(d AS TIMESTAMP) + slot * INTERVAL 5 MINUTE AS window_start,
       CAST(d AS TIMESTAMP) + (slot + 1) * INTERVAL 5 MINUTE AS window_end,
       5 AS window_size_minutes, CAST(hour(CAST(d AS TIMESTAMP) + slot * INTERVAL 5 MINUTE) AS INTEGER) AS hour_of_day
FROM s""",
    "fact_trades": FACT_TRADES,
    "fact_trades_contract": f"""
WITH v AS ({VIOLATED}),
d AS (SELECT processed_date, sum(n - 1) AS duplicate_keys
      FROM (SELECT max(processed_date) AS processed_date, count(*) AS n FROM v WHERE trade_id IS NOT NULL GROUP BY trade_id) GROUP BY 1),
c AS (SELECT processed_date, count(*) AS rows, count_if(is_sell IS NULL OR is_buyer_maker IS NULL OR price IS NULL) AS null_violations,
             count_if(is_sell IS NULL) AS null_sides, count_if(price IS NULL) AS null_prices FROM v GROUP BY 1)
SELECT processed_date, rows, CAST(null_violations AS BIGINT) AS null_violations, CAST(null_sides AS BIGINT) AS null_sides,
       CAST(null_prices AS BIGINT) AS null_prices, CAST(coalesce(duplicate_keys, 0) AS BIGINT) AS duplicate_keys
FROM c LEFT JOIN d USING (processed_date)""",
    "fact_pump_dump": f"""
SELECT trade_date, pump_window_start, pump_window_end,
       CAST(CAST(price_at_pump_start AS DECIMAL(20,10)) AS DOUBLE) AS price_at_pump_start,
       CAST(CAST(price_at_peak AS DECIMAL(20,10)) AS DOUBLE) AS price_at_peak,
       CAST(CAST(price_after_dump AS DECIMAL(20,10)) AS DOUBLE) AS price_after_dump,
       CAST(CAST(pump_pct AS DECIMAL(10,4)) AS DOUBLE) AS pump_pct,
       CAST(CAST(dump_pct AS DECIMAL(10,4)) AS DOUBLE) AS dump_pct,
       CAST(CAST(volume_usdt_during_pump AS DECIMAL(20,8)) AS DOUBLE) AS volume_usdt_during_pump,
       CAST(CAST(estimated_profit_pct AS DECIMAL(10,4)) AS DOUBLE) AS estimated_profit_pct,
       severity, processed_date
FROM ({EVENTS}) e""",
    "fact_wash_pairs": f"""
SELECT trade_date, buy_trade_id, sell_trade_id, time_diff_ms,
       CAST(CAST(price_diff_pct AS DECIMAL(10,6)) AS DOUBLE) AS price_diff_pct,
       CAST(CAST(qty_similarity_pct AS DECIMAL(10,4)) AS DOUBLE) AS qty_similarity_pct,
       CAST(CAST(wash_score AS DECIMAL(5,4)) AS DOUBLE) AS wash_score, processed_date
FROM ({WASH_J1}) w""",
    "orphan_dates": f"""
{DIM_SPAN}
SELECT f.processed_date, count(*) AS fact_rows, CAST(count_if(d.full_date IS NULL) AS BIGINT) AS orphan_rows
FROM ({FACT_TRADES}) f LEFT JOIN (SELECT * FROM d WHERE day(full_date) % 5 <> 0) d
     ON f.date_id = CAST(year(d.full_date) * 10000 + month(d.full_date) * 100 + day(d.full_date) AS INTEGER)
GROUP BY f.processed_date""",
    "dw_counts": f"""
{DIM_SPAN},
t AS (SELECT processed_date AS trade_date, count(*) AS n FROM ({SILVER}) s GROUP BY 1),
p AS (SELECT trade_date, count(*) AS n FROM ({EVENTS}) e GROUP BY 1),
w AS (SELECT trade_date, count(*) AS n FROM ({WASH_J1}) x GROUP BY 1)
SELECT d.full_date AS trade_date, coalesce(t.n, 0) AS fact_trades, coalesce(p.n, 0) AS fact_pump_dump_events,
       coalesce(w.n, 0) AS fact_wash_trade_pairs, coalesce(t.n, 0) > 0 AS ok
FROM d LEFT JOIN t ON t.trade_date = d.full_date LEFT JOIN p ON p.trade_date = d.full_date
       LEFT JOIN w ON w.trade_date = d.full_date""",
    "missing_days": f"{DIM_SPAN} SELECT full_date AS trade_date, full_date IN (SELECT trade_date FROM ({SPARSE}) t WHERE day(trade_date) % 7 <> 3) AS found FROM d",
    "zip_ingest": f"""
SELECT trade_id, price, qty, price * qty AS quote_qty, epoch_us(trade_time) AS time, is_buyer_maker, true AS is_best_match,
       trade_time, 'ABCUSDT-trades-' || strftime(trade_date, '%Y-%m-%d') || '.zip' AS _source_file, 'ABCUSDT' AS symbol, trade_date,
       true AS stamped
FROM ({SPARSE}) t""",
    "dim_date_seed": f"""
WITH s AS (SELECT min(trade_date) AS lo FROM ({SPARSE}) t),
d AS (SELECT CAST(g AS DATE) AS full_date FROM s, generate_series(s.lo::TIMESTAMP, s.lo::TIMESTAMP + INTERVAL 399 DAY, INTERVAL 1 DAY) AS gs(g)
      WHERE CAST(g AS DATE) <= DATE '2024-12-31')
SELECT {DIM_COLS} FROM d""",
    "day_reads": f"""
SELECT trade_date, count(*) AS trades, CAST(sum(trade_id) AS BIGINT) AS ids FROM ({SPARSE}) t
WHERE day(trade_date) % 2 = 0 GROUP BY trade_date""",
    "empty_day": f"SELECT DISTINCT trade_date, CAST(0 AS BIGINT) AS rows FROM ({SPARSE}) t",
    "warehouse_load": f"""
WITH t AS (SELECT trade_date, count(*) AS n, sum(CAST(CAST(usd_value AS DECIMAL(20,8)) AS DOUBLE)) AS usd FROM ({SPARSE}) s GROUP BY 1),
p AS (SELECT trade_date, count(*) AS n FROM ({EVENTS}) e GROUP BY 1)
SELECT CAST(year(t.trade_date) * 10000 + month(t.trade_date) * 100 + day(t.trade_date) AS INTEGER) AS date_id,
       CAST(isodow(t.trade_date) - 1 AS INTEGER) AS day_of_week, t.n AS trades, round(t.usd, 4) AS usd, coalesce(p.n, 0) AS pumps
FROM t LEFT JOIN p USING (trade_date)""",
    "symbols_dedup": f"""
SELECT symbol, trade_date, count(*) AS rows, CAST(sum(trade_id) AS BIGINT) AS ids, round(sum(price), 4) AS price_sum
FROM ({TWO_SYMBOLS}) t GROUP BY symbol, trade_date""",
    "symbols_candles": f"""
SELECT symbol, make_timestamp((epoch_us(trade_time) // 300000000) * 300000000) AS window_start,
       first(price ORDER BY trade_time, trade_id) AS open, last(price ORDER BY trade_time, trade_id) AS close, max(price) AS high,
       min(price) AS low, round(sum(qty), 6) AS volume, count(*) AS trades
FROM ({TWO_SYMBOLS}) t GROUP BY ALL""",
    "symbols_pump": f"""
SELECT 'AAAUSDT' AS symbol, count(*) AS events, round(sum(pump_pct), 6) AS pump_sum FROM ({EVENTS}) e
UNION ALL
SELECT 'BBBUSDT', count(*), round(sum(pump_pct), 6) FROM ({EVENTS}) e""",
    "symbols_wash": f"""
SELECT s.symbol, w.trade_date, w.buy_trade_id, w.sell_trade_id, round(w.wash_score, 6) AS wash_score
FROM ({WASH_J1}) w, (VALUES ('AAAUSDT'), ('BBBUSDT')) s(symbol)""",
    "day_overwrite": f"""
WITH c AS ({CANDLES}),
n AS (SELECT trade_date, count(*) AS candles FROM c GROUP BY trade_date),
k AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS i, count(*) OVER () AS m FROM n)
SELECT n.trade_date, n.candles FROM n JOIN k USING (trade_date) WHERE k.i <> k.m // 2 + 1""",
    "staged_audit": f"""
WITH b AS ({DIRTY}),
f AS (SELECT *, coalesce(price > 0, false) AS p_ok, coalesce(qty > 0, false) AS q_ok,
             coalesce(CAST(trade_time AS DATE) = trade_date, false) AS d_ok FROM b),
k AS (SELECT trade_date, trade_id, count(*) AS n, count_if(p_ok AND q_ok AND d_ok) AS kept FROM f GROUP BY 1, 2),
d AS (SELECT trade_date, sum(n - 1) AS again, sum(greatest(kept - 1, 0)) AS removed, count_if(kept > 0) AS rows_out FROM k GROUP BY 1)
SELECT f.trade_date, {_count('count(*)')} AS total_rows, {_count('count_if(price IS NULL OR price <= 0)')} AS invalid_prices,
       {_count('count_if(qty IS NULL OR qty <= 0)')} AS invalid_qty,
       {_count('count_if(trade_time IS NULL OR CAST(trade_time AS DATE) <> f.trade_date)')} AS out_of_range_timestamps,
       {_count('any_value(again)')} AS duplicate_trade_ids, {_count('count_if(NOT p_ok)')} AS removed_price,
       {_count('count_if(p_ok AND NOT q_ok)')} AS removed_qty, {_count('count_if(p_ok AND q_ok AND NOT d_ok)')} AS removed_date,
       {_count('any_value(removed)')} AS removed_duplicates, {_count('any_value(rows_out)')} AS rows_out
FROM f JOIN d USING (trade_date) GROUP BY f.trade_date""",
    "silver_publish": f"""
SELECT processed_date, count(*) AS rows, CAST(sum(trade_id) AS BIGINT) AS ids, round(sum(price), 4) AS prices, true AS refused
FROM ({SILVER}) s GROUP BY processed_date""",
    "facts_by_commit": f"""
WITH t AS (SELECT trade_date, count(*) AS trades, CAST(sum(trade_id) AS BIGINT) AS ids, count(*) AS keys FROM ({SPARSE}) s GROUP BY 1),
p AS (SELECT trade_date, count(*) AS n FROM ({EVENTS}) e GROUP BY 1)
SELECT t.*, coalesce(p.n, 0) AS pumps FROM t LEFT JOIN p USING (trade_date)""",
    "loaded_keys": f"""
SELECT trade_date AS processed_date, count(*) AS loaded_keys FROM ({SPARSE}) t WHERE trade_id % 7 = 0 GROUP BY 1""",
    "calendar": f"""
WITH d AS (SELECT CAST(g AS DATE) AS full_date FROM generate_series(TIMESTAMP '2026-01-01', TIMESTAMP '2027-02-04', INTERVAL 1 DAY) AS gs(g)
           UNION SELECT trade_date FROM ({SPARSE}) t)
SELECT {DIM_COLS} FROM d""",
    "symbols_warehouse": f"""
SELECT symbol, trade_date AS processed_date, count(*) AS trades, CAST(sum(trade_id) AS BIGINT) AS ids,
       round(sum(CAST(CAST(price AS DECIMAL(20,10)) AS DOUBLE)), 4) AS prices
FROM ({TWO_SYMBOLS}) t WHERE symbol = 'AAAUSDT' OR trade_id % 2 = 0
    OR trade_date NOT IN (SELECT trade_date FROM ({SPARSE}) s WHERE trade_id % 2 = 0 AND trade_id % 3 <> 0) GROUP BY 1, 2""",
    "landing_csv": f"""
SELECT trade_id, price, qty, price * qty AS quote_qty, epoch_us(trade_time) AS time, is_buyer_maker, true AS is_best_match,
       'ABCUSDT-trades-' || strftime(trade_date, '%Y-%m-%d') || '.csv' AS _source_file, trade_date
FROM ({SPARSE}) t""",
    "candle_order": f"""
SELECT trade_date, count(*) AS candles, CAST(0 AS BIGINT) AS out_of_order FROM ({CANDLES}) c GROUP BY trade_date""",
}
