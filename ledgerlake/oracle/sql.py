"""DuckDB oracle SQL, one self-contained statement per catalog query.

Typed anew from the specification of each query, in a shape of its own: facts
by FILTER aggregates, the favourite symbol by ``arg_min``, reports from one
roll-up per portfolio joined to its owner, labels and limits from small VALUES
tables.  The driver registers the source tables as views.

Conventions shared with the Spark side: as-of date 2024-01-31; money summed as
DECIMAL (``E``) and averaged in whole units (``Q``); published doubles rounded
HALF_UP through a decimal with ten guard digits (``R``); integer sums cast to
BIGINT.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-31'"


def R(expr: str, n: int) -> str:
    # by way of the shortest text of the double, which is exact; the direct cast
    # multiplies in binary and misses ties
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,{n + 10})), {n}) AS DOUBLE)"


def E(expr: str, scale: int = 8) -> str:
    """A double as an exact decimal, HALF_UP."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL({scale + 18},{scale}))"


def DBL(expr: str) -> str:
    """The double nearest to a decimal."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"


def units(total: str) -> str:
    """A decimal as the whole number of its last places."""
    return f"CAST(replace(CAST({total} AS VARCHAR), '.', '') AS HUGEINT)"


def Q(total: str, n: str, scale: int, of: int) -> str:
    """A decimal of ``of`` places over a count, HALF_UP, in units of ``scale``."""
    up, down = (10 ** (scale - of), 1) if scale >= of else (1, 10 ** (of - scale))
    u, n = units(total), f"CAST({n} AS HUGEINT)"
    return f"CASE WHEN {n} > 0 THEN sign({u}) * ((2 * abs({u}) * {up} + {n} * {down}) // (2 * {n} * {down})) END"


def number(u: str, scale: int) -> str:
    """Units of ``scale`` as the nearest double."""
    u = f"({u})"
    return (f"CAST(CASE WHEN {u} < 0 THEN '-' ELSE '' END || (abs({u}) // {10 ** scale}) || '.' || "
            f"lpad(CAST(abs({u}) % {10 ** scale} AS VARCHAR), {scale}, '0') AS DOUBLE)")


def window(days: int, ds: str = "ds") -> str:
    return f"{ds} BETWEEN {AS_OF} - {days} AND {AS_OF}"


DOMAIN = f"""
d_users AS (
  SELECT printf('USER_%06d', c_custkey + 1) AS user_id, c_name AS name, r_name AS region,
         COALESCE(segment.profile, 'very_aggressive') AS risk_profile,
         (['pending', 'rejected', 'under_review'])[GREATEST(CAST(c_custkey % 20 AS INTEGER) - 16, 0)] AS not_verified,
         COALESCE(not_verified, 'verified') AS kyc_status,
         DATE '2024-01-31' - CAST((c_custkey * 13) % 730 AS INTEGER) AS signed_up,
         CAST(21 + (c_custkey * 7) % 55 AS INTEGER) AS age,
         CAST(30000 + floor(abs(c_acctbal) * 47) AS INTEGER) AS income
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (VALUES ('HOUSEHOLD', 'conservative'), ('FURNITURE', 'conservative'),
                    ('BUILDING', 'moderate'), ('MACHINERY', 'aggressive')) AS segment(name, profile)
    ON segment.name = c_mktsegment),
d_portfolios AS (
  SELECT printf('PORT_%06d', no) AS portfolio_id, printf('USER_%06d', c_custkey + 1) AS user_id,
         no, c_custkey,
         (['USD', 'EUR', 'GBP', 'JPY', 'AUD'])[CAST(no % 5 AS INTEGER) + 1] AS base_ccy,
         no % 20 <> 0 AS is_active
  FROM (SELECT c_custkey, 2 * c_custkey + 1 + extra AS no
        FROM customer, (VALUES (0), (1)) AS twice(extra)
        WHERE extra = 0 OR c_custkey % 3 = 2)),
listed AS (SELECT MAX(p_partkey) + 1 AS n FROM part),
ev AS (
  SELECT events.*, event_id * 7 + user_id AS h, n + n // 10 + 1 AS wide, n // 100 + 1 AS popular
  FROM events, listed),
d_trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id,
         printf('PORT_%06d', 2 * user_id + 1
                + CASE WHEN user_id % 3 = 2 AND event_id % 2 = 1 THEN 1 ELSE 0 END) AS portfolio_id,
         printf('SYM_%02d', CASE user_id % 5
             WHEN 0 THEN (CASE WHEN event_id % 2 = 0 THEN user_id % popular ELSE h % wide END)
             WHEN 1 THEN h % (popular // 4 + 1)
             WHEN 2 THEN h % (popular // 2 + 1)
             WHEN 3 THEN h % popular
             ELSE h % wide END) AS symbol,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'BUY' ELSE 'SELL' END AS side,
         CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN -value
              WHEN event_type = 'error' AND event_id % 10 = 1 THEN NULL
              ELSE value END AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty,
         ts,
         (['NYSE', 'NASDAQ', 'BATS', 'IEX', 'ARCA'])[CAST(event_id % 5 AS INTEGER) + 1] AS venue,
         CAST(ts AS DATE) AS event_date
  FROM ev),
d_symbols AS (
  SELECT printf('SYM_%02d', p_partkey) AS symbol,
         CASE WHEN p_partkey % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
         CASE WHEN p_partkey % 11 <> 10 THEN p_type END AS sector,
         CAST(0.01 AS DOUBLE) AS tick_size
  FROM part),
rate_feed AS (
  SELECT 'USD' AS base_ccy,
         (['USD', 'EUR', 'GBP', 'JPY', 'AUD'])[CAST(event_id % 5 AS INTEGER) + 1] AS quote_ccy,
         CASE WHEN event_id % 5 = 0 THEN CAST(1 AS DOUBLE)
              ELSE 1 + value / CAST(100 AS DOUBLE) END AS rate,
         CAST(ts AS DATE) AS ds
  FROM events),
rates AS (
  SELECT base_ccy, quote_ccy, ds, MIN(rate) AS rate FROM rate_feed GROUP BY ALL)"""

BRANDS = """
b_trades AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS trade_id,
         printf('PORT_%06d', 2 * o_custkey + 1) AS portfolio_id, p_brand AS symbol,
         CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS side,
         CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS price,
         CAST(l_quantity AS BIGINT) AS qty, l_shipdate AS ts, 'any' AS venue,
         CAST(l_shipdate AS DATE) AS event_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
b_symbols AS (
  SELECT p_brand AS symbol, MIN(p_type) AS sector,
         CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 2 = 0
              THEN 'NYSE' ELSE 'NASDAQ' END AS exchange
  FROM part GROUP BY p_brand)"""


def facts(trades: str = "d_trades", symbols: str = "d_symbols") -> str:
    """Silver and the three gold facts over a feed and its symbol master."""
    return f"""
scored AS (
  SELECT t.*, s.exchange, s.sector, t.price AS price_usd, t.price * t.qty AS notional_usd,
         t.price > 0 AND t.qty > 0 AND t.symbol IS NOT NULL AND s.exchange IS NOT NULL AS is_valid,
         CAST(100 - 50 * COALESCE(CAST(NOT is_valid AS INTEGER), 0)
              - 10 * CAST(s.sector IS NULL AS INTEGER) AS INTEGER) AS quality_score
  FROM {trades} t LEFT JOIN {symbols} s USING (symbol)),
valid AS (SELECT event_date AS ds, * FROM scored WHERE is_valid),
positions AS (
  SELECT ds, portfolio_id, symbol,
         COALESCE(SUM(qty) FILTER (side = 'BUY'), 0) AS bought,
         COALESCE(SUM(qty) FILTER (side = 'SELL'), 0) AS sold,
         SUM({E("price_usd")}) FILTER (side = 'BUY') AS bought_at,
         SUM({E("price_usd")}) FILTER (side = 'SELL') AS sold_at,
         SUM({E("notional_usd")}) AS turnover, COUNT(*) AS n,
         COUNT(*) FILTER (side = 'BUY') AS n_buy, COUNT(*) FILTER (side = 'SELL') AS n_sell
  FROM valid GROUP BY ALL),
priced AS (
  SELECT *, LEAST(bought, sold) * (earned - paid) AS gained
  FROM (SELECT *, COALESCE({Q("bought_at", "n_buy", 10, 8)}, 0) AS paid,
               COALESCE({Q("sold_at", "n_sell", 10, 8)}, 0) AS earned
        FROM positions)),
f_pnl AS (
  SELECT ds, portfolio_id, symbol, CAST(bought AS INTEGER) AS buy_qty, CAST(sold AS INTEGER) AS sell_qty,
         CAST(bought - sold AS INTEGER) AS net_qty, {number("paid", 10)} AS avg_buy_price,
         {number("earned", 10)} AS avg_sell_price, {number("gained", 10)} AS realized_pnl_usd,
         {DBL("turnover")} AS notional_traded_usd, CAST(n AS INTEGER) AS num_trades
  FROM priced),
f_act AS (
  SELECT ds, portfolio_id, CAST(SUM(n) AS INTEGER) AS num_trades,
         CAST(COUNT(*) AS INTEGER) AS unique_symbols, {DBL("SUM(turnover)")} AS total_notional_usd,
         CASE WHEN SUM(n_sell) > 0 THEN CAST(SUM(n_buy) AS DOUBLE) / CAST(SUM(n_sell) AS DOUBLE)
              ELSE CAST(999 AS DOUBLE) END AS buy_sell_ratio,
         arg_min(symbol, (-n, symbol)) AS most_traded_symbol, MAX(n) AS favourite_trades,
         CAST((SELECT MAX(score) FROM (VALUES (0, 20), (2, 40), (5, 60), (10, 80)) AS step(least, score)
               WHERE SUM(n) >= least) AS INTEGER) AS activity_score
  FROM positions GROUP BY ds, portfolio_id),
f_liq AS (
  SELECT ds, symbol, exchange, sector, CAST(qty AS BIGINT) AS total_volume,
         {DBL("turnover")} AS total_turnover_usd, CAST(count_ AS INTEGER) AS num_trades, unique_portfolios,
         {number(f"({Q('turnover', 'count_', 10, 8)})", 10)} AS avg_trade_size, price_volatility
  FROM (SELECT ds, symbol, exchange, sector, SUM(qty) AS qty, SUM({E("notional_usd")}) AS turnover, COUNT(*) AS count_,
               CAST(COUNT(DISTINCT portfolio_id) AS INTEGER) AS unique_portfolios,
               COALESCE(STDDEV_SAMP(price_usd), 0) AS price_volatility
        FROM valid GROUP BY ds, symbol, exchange, sector))"""


OWNERS = """
own AS (SELECT u.*, p.portfolio_id FROM d_users u JOIN d_portfolios p USING (user_id)),
known AS (SELECT * FROM own WHERE kyc_status = 'verified')"""


def pnl_roll(days: int) -> str:
    """One row per portfolio: its PnL rows of the window."""
    return f"""
roll AS (
  SELECT portfolio_id, COUNT(*) AS rows_, SUM(num_trades) AS trades,
         SUM({E("realized_pnl_usd", 10)}) AS gain, SUM({E("abs(realized_pnl_usd)", 10)}) AS swing,
         SUM({E("notional_traded_usd", 10)}) AS volume,
         COUNT(DISTINCT symbol) AS symbols, list_distinct(list(symbol)) AS symbol_list,
         list_distinct(list(ds)) AS day_list
  FROM f_pnl WHERE {window(days)} GROUP BY portfolio_id)"""


def act_roll(days: int) -> str:
    return f"""
roll AS (
  SELECT portfolio_id, COUNT(*) AS rows_, SUM(num_trades) AS trades,
         SUM(activity_score) AS score, SUM({E("total_notional_usd", 10)}) AS volume
  FROM f_act WHERE {window(days)} GROUP BY portfolio_id)"""


def q(body: str, rounded: list[str] = (), ctes: list[str] = (), feed: str = "") -> str:
    """The domain, the facts over a feed, further CTEs, and ``body``; the named
    double columns are rounded to 6 decimals (as the Spark catalog does)."""
    parts = [DOMAIN, feed, facts("b_trades", "b_symbols") if feed else facts(), OWNERS, *ctes]
    sql = "WITH " + ",".join(p.strip("\n") for p in parts if p) + "\n" + body.strip()
    if not rounded:
        return sql
    swaps = ", ".join(f"{R(c, 6)} AS {c}" for c in rounded)
    return f"SELECT * REPLACE ({swaps}) FROM (\n{sql}\n) AS oracle"


PNL_DOUBLES = ["avg_buy_price", "avg_sell_price", "realized_pnl_usd", "notional_traded_usd"]
LIQ_DOUBLES = ["total_turnover_usd", "avg_trade_size", "price_volatility"]
ACT_DOUBLES = ["total_notional_usd", "buy_sell_ratio"]
TRADE = "trade_id, portfolio_id, symbol, side, price, qty, ts, venue, event_date"
ENRICHED = f"{TRADE}, exchange, sector, price_usd, notional_usd, is_valid, quality_score"
ACT = "SELECT * EXCLUDE (favourite_trades) FROM f_act"
# The last two days of the feed, delivered again: the day before the last is
# withdrawn; of the last, even ids go and the others are re-booked.
AGAIN = """
ending AS (SELECT MAX(event_date) AS d FROM d_trades),
again AS (
  SELECT d_trades.* REPLACE ('SYM_00' AS symbol) FROM d_trades, ending
  WHERE event_date = d AND CAST(trade_id AS BIGINT) % 2 = 1
  UNION ALL
  SELECT d_trades.* FROM d_trades, ending WHERE event_date < d - 1)"""
# Deliveries on the 3rd, 12th and 21st: keys 3 mod 7 change their sector and keys
# 5 mod 13 are gone in the second, the odd ones of both also in the third.
STATES = """
states AS (
  SELECT printf('SYM_%02d', k) AS symbol, CASE WHEN k % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
         CASE WHEN piece = 1 AND moved THEN 'RECLASSIFIED' ELSE home END AS sector, CAST(0.01 AS DOUBLE) AS tick_size,
         [DATE '2024-01-03', DATE '2024-01-12', DATE '2024-01-21'][piece + 1] AS valid_from,
         CASE WHEN piece = 0 THEN DATE '2024-01-11' WHEN piece = 1 AND k % 2 = 0 THEN DATE '2024-01-20' END AS valid_to
  FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 <> 10 THEN p_type END AS home,
               p_partkey % 7 = 3 AS moved, p_partkey % 13 = 5 AS left_ FROM part), (VALUES (0), (1), (2)) AS v(piece)
  WHERE (moved OR left_) AND NOT (left_ AND piece = 1) AND NOT (piece = 2 AND k % 2 = 1)
  UNION ALL
  SELECT symbol, exchange, sector, tick_size, DATE '2024-01-03', NULL FROM d_symbols JOIN part
    ON symbol = printf('SYM_%02d', p_partkey) WHERE p_partkey % 7 <> 3 AND p_partkey % 13 <> 5)"""
RATE_LINES = """
lines AS (
  SELECT CAST(ts AS DATE) AS ds, (['USD', 'EUR', 'GBP', 'JPY', 'AUD'])[CAST(event_id % 5 AS INTEGER) + 1] AS ccy,
         CAST(CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 1 + value / 100 END AS DECIMAL(12,4)) AS VARCHAR) AS rate,
         CASE event_id % 40 WHEN 3 THEN 'USD,' || ccy || ',n/a' WHEN 13 THEN 'USD,' || ccy
              WHEN 23 THEN 'USD,' || ccy || ',' || rate || ',9' WHEN 33 THEN 'USD,,1.5' END AS line,
         CASE event_id % 40 WHEN 3 THEN 'type:rate' WHEN 13 THEN 'fields' WHEN 23 THEN 'fields'
              WHEN 33 THEN 'missing:quote_ccy' END AS reason
  FROM events)"""
AGE_BANDS = "(VALUES (0, 30, '18-29'), (30, 40, '30-39'), (40, 50, '40-49'), (50, 60, '50-59'), (60, 999, '60+'))"
LIFE_BANDS = "(VALUES (0, 30, 'Young (18-29)'), (30, 50, 'Middle (30-49)'), (50, 999, 'Senior (50+)'))"
HALVES = "(VALUES (0, 30, 'Young'), (30, 999, 'Senior'))"
INCOMES = """(VALUES (0, 50000, '< $50K'), (50000, 100000, '$50K-$100K'),
             (100000, 200000, '$100K-$200K'), (200000, 2000000000, '$200K+'))"""


def band(values: str, what: str) -> str:
    return f"JOIN {values} AS band(low, high, label) ON {what} >= low AND {what} < high"


def again(fact: str) -> str:
    """A statement over the feed as it is after the second delivery."""
    parts = [DOMAIN, AGAIN, facts("again"), fact]
    return "WITH " + ",".join(p.strip("\n") for p in parts[:-1]) + "\n" + parts[-1]


def _layers() -> dict[str, str]:
    o: dict[str, str] = {}
    o["fx_bronze"] = q("SELECT base_ccy, quote_ccy, rate, ds FROM rates")
    o["fx_missing_days"] = q(f"""
SELECT CAST(d AS DATE) AS ds FROM range(DATE '2024-01-01', {AS_OF} + 1, INTERVAL 1 DAY) AS r(d)
EXCEPT SELECT ds FROM rate_feed""")
    o["fx_latest_day"] = q("""
SELECT base_ccy, quote_ccy, rate, ds FROM rates WHERE ds = (SELECT MAX(ds) FROM rate_feed)""")
    o["fx_rejects"] = q("SELECT ds, line, reason FROM lines WHERE reason IS NOT NULL", ctes=[RATE_LINES])
    o["fx_quarantine"] = q("""
SELECT ds, COUNT(*) FILTER (reason IS NULL) AS good_rows, COUNT(reason) AS rejected_rows,
       COUNT(DISTINCT ccy) FILTER (reason IS NULL) AS rates
FROM lines GROUP BY ds""", ctes=[RATE_LINES])
    o["symbols_bronze"] = q("SELECT symbol, exchange, sector, tick_size FROM d_symbols")
    o["trades_scan"] = q(f"SELECT {TRADE} FROM d_trades WHERE {window(30, 'event_date')}")
    o["trades_enriched"] = q(f"SELECT {ENRICHED} FROM scored")
    o["roundtrip_silver"] = again(f"SELECT {ENRICHED} FROM scored")
    o["silver_valid_trades"] = q(f"""
SELECT ds, portfolio_id, symbol, side, price_usd, qty, notional_usd, is_valid
FROM valid WHERE {window(30)}""")
    o["quality_score_histogram"] = q(
        "SELECT quality_score, is_valid, COUNT(*) AS num_trades FROM scored GROUP BY ALL")
    o["fact_pnl_daily"] = o["pnl_outer_join"] = q("FROM f_pnl", PNL_DOUBLES)
    swaps = ", ".join(f"{R(c, 6)} AS {c}" for c in PNL_DOUBLES)
    o["roundtrip_fact_pnl"] = again(f"SELECT * REPLACE ({swaps}) FROM f_pnl")
    o["published_fact_pnl"] = o["roundtrip_fact_pnl"]
    days = "BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    o["published_run"] = q(f"""
SELECT start, "end", table_name, CASE WHEN start < '2030' OR table_name = 'br_symbols' THEN n ELSE 0 END AS written,
       n AS found
FROM (SELECT 'br_symbols' AS table_name, COUNT(*) AS n FROM d_symbols
      UNION ALL SELECT 'br_fx_rates', COUNT(*) FROM rates WHERE ds {days}
      UNION ALL SELECT 'trades_enriched', COUNT(*) FROM d_trades WHERE event_date {days}
      UNION ALL SELECT 'fact_pnl_daily', COUNT(*) FROM f_pnl WHERE ds {days}
      UNION ALL SELECT 'fact_liquidity', COUNT(*) FROM f_liq WHERE ds {days}
      UNION ALL SELECT 'fact_user_activity', COUNT(*) FROM f_act WHERE ds {days}),
     (VALUES ('2024-01-05', '2024-01-20'), ('2030-01-01', '2030-01-02')) AS windows(start, "end")""")
    o["layer_stamps"] = q(f"""
SELECT table_name, n AS num_rows, n AS stamped, CAST(1 AS BIGINT) AS moments
FROM (SELECT 'br_symbols' AS table_name, COUNT(*) AS n FROM d_symbols
      UNION ALL SELECT 'br_fx_rates', COUNT(*) FROM rates WHERE ds {days}
      UNION ALL SELECT 'trades_enriched', COUNT(*) FROM d_trades WHERE event_date {days})""")
    o["fact_liquidity"] = q("FROM f_liq", LIQ_DOUBLES)
    o["fact_user_activity"] = q(ACT, ACT_DOUBLES)
    for fact in ("pnl", "liquidity", "user_activity"):
        o[f"incremental_fact_{fact}"] = o["fact_pnl_daily" if fact == "pnl" else f"fact_{fact}"]
    o["active_owners_30d"] = q(f"""
SELECT region, COUNT(DISTINCT ds) AS num_days, COUNT(DISTINCT portfolio_id) AS num_portfolios,
       COUNT(DISTINCT user_id) AS num_users, true AS estimates_close
FROM valid JOIN own USING (portfolio_id) WHERE {window(30)} GROUP BY region""")
    o["lineitem_fact_pnl_daily"] = q("FROM f_pnl", PNL_DOUBLES, feed=BRANDS)
    o["lineitem_fact_liquidity"] = q("FROM f_liq", LIQ_DOUBLES, feed=BRANDS)
    o["lineitem_fact_user_activity"] = q(ACT, ACT_DOUBLES, feed=BRANDS)
    o["most_traded_symbol"] = q("""
SELECT ds, portfolio_id, most_traded_symbol, favourite_trades AS symbol_trade_count FROM f_act""")
    o["top_pnl_rows"] = q(
        "FROM f_pnl ORDER BY realized_pnl_usd DESC, ds, portfolio_id, symbol LIMIT 10", PNL_DOUBLES)
    o["top_turnover_rows"] = q(
        "FROM f_liq ORDER BY total_turnover_usd DESC, ds, symbol LIMIT 10", LIQ_DOUBLES)
    o["top_activity_rows"] = q(
        ACT + " ORDER BY activity_score DESC, ds, portfolio_id LIMIT 10", ACT_DOUBLES)
    o["daily_bars"] = q("""
SELECT ds, symbol, first(price_usd ORDER BY ts, CAST(trade_id AS BIGINT)) AS open,
       MAX(price_usd) AS high, MIN(price_usd) AS low,
       last(price_usd ORDER BY ts, CAST(trade_id AS BIGINT)) AS close,
       CAST(SUM(qty) AS BIGINT) AS volume
FROM valid GROUP BY ds, symbol""")
    o["sector_turnover"] = q(f"""
SELECT ds, sector, SUM({E("notional_usd")}) AS turnover_usd, CAST(SUM(qty) AS BIGINT) AS volume,
       COUNT(*) AS num_trades
FROM valid GROUP BY ds, sector""", ["turnover_usd"])
    o["trades_in_base_ccy"] = q("""
SELECT trade_id, portfolio_id, ds, p.base_ccy, notional_usd, rate AS fx_rate,
       notional_usd * rate AS notional_base_ccy
FROM valid JOIN d_portfolios p USING (portfolio_id)
LEFT JOIN rates ON rates.quote_ccy = p.base_ccy AND rates.ds = valid.ds""".replace(
        "SELECT trade_id, portfolio_id, ds,", "SELECT trade_id, portfolio_id, valid.ds,"))
    o["trades_in_base_ccy_as_of"] = q("""
SELECT trade_id, portfolio_id, owned.ds, owned.base_ccy, notional_usd, rate AS fx_rate,
       notional_usd * rate AS notional_base_ccy
FROM (SELECT valid.*, p.base_ccy FROM valid JOIN d_portfolios p USING (portfolio_id)) AS owned
ASOF LEFT JOIN (SELECT * FROM rates WHERE day(ds) % 4 = 3) AS quoted
  ON quoted.quote_ccy = owned.base_ccy AND owned.ds >= quoted.ds""")
    o["portfolio_trades"] = q(f"""
SELECT {ENRICHED} FROM scored WHERE portfolio_id = (SELECT MAX(portfolio_id) FROM d_trades)""")
    o["symbol_history"] = q("SELECT symbol, exchange, sector, tick_size, valid_from, valid_to FROM states",
                            ctes=[STATES])
    o["trades_enriched_history"] = q("""
SELECT trade_id, t.symbol, event_date, s.exchange, s.sector,
       t.price > 0 AND t.qty > 0 AND s.exchange IS NOT NULL AS is_valid,
       CAST(100 - 50 * COALESCE(CAST(NOT is_valid AS INTEGER), 0)
            - 10 * CAST(s.sector IS NULL AS INTEGER) AS INTEGER) AS quality_score
FROM d_trades t LEFT JOIN states s
  ON s.symbol = t.symbol AND event_date BETWEEN valid_from AND COALESCE(valid_to, DATE '9999-12-31')""",
                                     ctes=[STATES])
    o["holdings_value"] = q(f"""
SELECT portfolio_id, CAST(1 AS BIGINT) AS num_positions,
       CAST(last_price IS NOT NULL AS BIGINT) AS priced_positions,
       (c_custkey % 100 + 1) * {E("last_price")} AS holdings_value_usd
FROM d_portfolios, listed LEFT JOIN closing ON symbol = printf('SYM_%02d', no % n)""",
                            ["holdings_value_usd"], [f"""
closing AS (
  SELECT symbol, last(price_usd ORDER BY ts, CAST(trade_id AS BIGINT)) AS last_price
  FROM valid WHERE ds <= {AS_OF} GROUP BY symbol)"""])
    o["engagement_bands"] = q("""
SELECT label AS engagement_band, COUNT(*) AS num_portfolio_days,
       COUNT(DISTINCT portfolio_id) AS num_portfolios
FROM f_act JOIN (VALUES (80, 'Power user'), (60, 'Active trader'), (40, 'Moderate activity'),
                        (20, 'Low activity')) AS named(score, label) ON score = activity_score
GROUP BY label""")
    o["regional_symbol_activity"] = q("""
SELECT ds, region, symbol, CAST(SUM(n) AS BIGINT) AS num_trades,
       CAST(SUM(bought + sold) AS BIGINT) AS total_volume, SUM(turnover) AS total_turnover_usd,
       COUNT(DISTINCT portfolio_id) AS unique_portfolios
FROM own JOIN positions USING (portfolio_id) GROUP BY ALL""", ["total_turnover_usd"])
    o["users_by_region"] = q("SELECT region, COUNT(*) AS num_users FROM d_users GROUP BY region")
    o["users_by_risk_profile"] = q(
        "SELECT risk_profile, COUNT(*) AS num_users FROM d_users GROUP BY risk_profile")
    o["active_portfolios"] = q("""
SELECT COUNT(*) AS total_portfolios, COUNT(*) FILTER (is_active) AS active_portfolios
FROM d_portfolios""")
    o["table_counts"] = q("""
SELECT 'users' AS table_name, COUNT(*) AS row_count FROM d_users
UNION ALL SELECT 'portfolios', COUNT(*) FROM d_portfolios
UNION ALL SELECT 'trades_stream', COUNT(*) FROM d_trades
UNION ALL SELECT 'symbols', COUNT(*) FROM d_symbols""")
    o["portfolio_ids"] = q("SELECT portfolio_id, user_id, base_ccy, is_active FROM d_portfolios")
    o["weekday_trades"] = q(f"""
SELECT ds, CAST(isodow(ds) - 1 AS INTEGER) AS weekday, COUNT(*) AS num_trades,
       SUM({E("notional_usd")}) AS notional_usd
FROM valid WHERE isodow(ds) < 6 GROUP BY ds""", ["notional_usd"])
    return o


def _reports() -> dict[str, str]:
    o: dict[str, str] = {}
    o["top_profitable_users"] = q("""
SELECT user_id, name, region, risk_profile, COUNT(*) AS num_portfolios, SUM(gain) AS total_pnl_usd,
       SUM(volume) AS total_volume_usd,
       CAST(len(list_distinct(flatten(list(symbol_list)))) AS BIGINT) AS unique_symbols_traded
FROM known JOIN roll USING (portfolio_id)
GROUP BY user_id, name, region, risk_profile
ORDER BY total_pnl_usd DESC, user_id LIMIT 20""", ["total_pnl_usd", "total_volume_usd"], [pnl_roll(7)])
    o["risk_profile_performance"] = q(f"""
SELECT risk_profile, COUNT(DISTINCT user_id) AS num_users, CAST(SUM(trades) AS BIGINT) AS total_trades,
       {number(Q("SUM(trades)", "SUM(rows_)", 2, 0), 2)} AS avg_trades_per_portfolio,
       {R("SUM(gain)", 2)} AS total_pnl_usd, {number(Q("SUM(gain)", "SUM(rows_)", 2, 10), 2)} AS avg_pnl_per_position
FROM known LEFT JOIN roll USING (portfolio_id) GROUP BY risk_profile""", ctes=[pnl_roll(30)])
    o["age_group_activity"] = q(f"""
SELECT label AS age_group, COUNT(DISTINCT user_id) AS num_users,
       CAST(SUM(trades) AS BIGINT) AS total_trades,
       {number(Q("SUM(score)", "SUM(rows_)", 2, 0), 2)} AS avg_activity_score, {R("SUM(volume)", 2)} AS total_traded_usd
FROM known {band(AGE_BANDS, "age")} LEFT JOIN roll USING (portfolio_id) GROUP BY label""", ctes=[act_roll(30)])
    o["income_bracket_activity"] = q(f"""
SELECT label AS income_bracket, COUNT(DISTINCT user_id) AS num_users,
       CAST(SUM(trades) AS BIGINT) AS total_trades,
       {number(Q("SUM(volume)", "SUM(rows_)", 2, 10), 2)} AS avg_traded_per_user
FROM known {band(INCOMES, "income")} LEFT JOIN roll USING (portfolio_id) GROUP BY label""", ctes=[act_roll(30)])
    o["activation_rate"] = q(f"""
SELECT CAST(date_trunc('month', signed_up) AS DATE) AS signup_month, COUNT(*) AS new_users,
       COUNT(*) FILTER (latest >= date_trunc('month', signed_up)) AS active_users,
       {R("100.0 * COUNT(*) FILTER (latest >= date_trunc('month', signed_up)) / COUNT(*)", 2)}
         AS activation_rate_pct
FROM d_users LEFT JOIN seen USING (user_id)
WHERE kyc_status = 'verified' AND signed_up BETWEEN {AS_OF} - INTERVAL 12 MONTH AND {AS_OF}
GROUP BY signup_month""", ctes=[f"""
seen AS (
  SELECT user_id, MAX(ds) AS latest FROM own JOIN f_act USING (portfolio_id)
  WHERE num_trades > 0 AND ds <= {AS_OF} GROUP BY user_id)"""])
    o["pnl_by_risk_profile"] = q(f"""
SELECT risk_profile, {number(Q(f"SUM({E('realized_pnl_usd', 10)})", "COUNT(*)", 16, 10), 16)} AS avg_pnl
FROM own JOIN f_pnl USING (portfolio_id) GROUP BY risk_profile""", ["avg_pnl"])
    o["activity_by_age_band"] = q(f"""
SELECT label AS age_group, AVG(num_trades) AS avg_trades, AVG(activity_score) AS avg_activity
FROM own {band(LIFE_BANDS, "age")} JOIN f_act USING (portfolio_id) GROUP BY label""",
                                  ["avg_trades", "avg_activity"])
    o["activity_by_age_split"] = q(f"""
SELECT label AS age_group, AVG(activity_score) AS avg_activity_score
FROM own {band(HALVES, "age")} JOIN f_act USING (portfolio_id) GROUP BY label""", ["avg_activity_score"])
    o["regional_volume"] = q(f"""
SELECT region, COUNT(DISTINCT user_id) AS num_users, COUNT(*) AS num_portfolios,
       CAST(SUM(trades) AS BIGINT) AS total_trades, {R("SUM(volume)", 2)} AS total_volume_usd,
       {number(Q("SUM(score)", "SUM(rows_)", 2, 0), 2)} AS avg_activity_score
FROM known LEFT JOIN roll USING (portfolio_id) GROUP BY region""", ctes=[act_roll(30)])
    o["regional_profitability"] = q(f"""
SELECT region, COUNT(DISTINCT user_id) AS num_users, {R("SUM(gain)", 2)} AS total_pnl_usd,
       {number(Q("SUM(gain)", "SUM(rows_)", 2, 10), 2)} AS avg_pnl_per_position,
       {R(f"{DBL('SUM(gain)')} / {DBL('SUM(volume)')} * 100", 4)} AS roi_percentage
FROM known LEFT JOIN roll USING (portfolio_id) GROUP BY region""", ctes=[pnl_roll(30)])
    o["regional_profitability_from_store"] = o["regional_profitability"]
    o["regional_risk_distribution"] = q("""
SELECT region, risk_profile, COUNT(DISTINCT user_id) AS num_users,
       CAST(SUM(trades) AS BIGINT) AS total_trades
FROM known LEFT JOIN roll USING (portfolio_id) GROUP BY region, risk_profile""", ctes=[act_roll(7)])
    o["regional_symbol_preferences"] = q(f"""
SELECT region, symbol, COUNT(DISTINCT portfolio_id) AS num_portfolios_traded,
       CAST(SUM(num_trades) AS BIGINT) AS total_trades,
       {R(f"SUM({E('notional_traded_usd', 10)})", 2)} AS total_volume_usd
FROM f_pnl JOIN known USING (portfolio_id) WHERE {window(30)}
GROUP BY region, symbol HAVING total_trades > 10""")
    o["pnl_by_region"] = q(f"""
SELECT region, SUM({E("realized_pnl_usd", 10)}) AS total_pnl_usd,
       SUM({E("realized_pnl_usd", 10)}) FILTER ({window(7)}) AS pnl_last_7d_usd
FROM f_pnl JOIN own USING (portfolio_id) WHERE ds <= {AS_OF}
GROUP BY region""", ["total_pnl_usd", "pnl_last_7d_usd"])
    o["portfolio_concentration"] = q(f"""
SELECT user_id, name, region, risk_profile, portfolio_id, symbol,
       {R("part_usd", 2)} AS symbol_volume_usd, {R("volume", 2)} AS portfolio_total_usd,
       {R("share * 100", 2)} AS concentration_pct,
       CASE WHEN share > 0.5 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level
FROM known JOIN roll USING (portfolio_id) JOIN held USING (portfolio_id),
     LATERAL (SELECT {DBL("part_usd")} / {DBL("volume")} AS share)
WHERE share > 0.3
ORDER BY concentration_pct DESC, portfolio_id, symbol LIMIT 50""", ctes=[pnl_roll(30), f"""
held AS (
  SELECT portfolio_id, symbol, SUM({E("notional_traded_usd", 10)}) AS part_usd
  FROM f_pnl WHERE {window(30)} GROUP BY portfolio_id, symbol)"""])
    o["high_risk_users"] = q(f"""
SELECT user_id, name, risk_profile, COUNT(*) AS num_portfolios, SUM(volume) AS total_volume_30d,
       CAST(len(list_distinct(flatten(list(symbol_list) FILTER (symbol_list IS NOT NULL)))) AS BIGINT)
         AS unique_symbols,
       {number(Q("SUM(swing)", "SUM(rows_)", 2, 10), 2)} AS avg_absolute_pnl
FROM known LEFT JOIN roll USING (portfolio_id)
WHERE risk_profile LIKE '%aggressive'
GROUP BY user_id, name, risk_profile HAVING SUM(volume) > 100000
ORDER BY total_volume_30d DESC, user_id LIMIT 30""", ["total_volume_30d"], [pnl_roll(30)])
    o["loss_making_users"] = q(f"""
SELECT user_id, name, region, risk_profile,
       CAST(len(list_distinct(flatten(list(day_list)))) AS BIGINT) AS trading_days,
       CAST(SUM(trades) AS BIGINT) AS total_trades, {R("SUM(gain)", 2)} AS total_pnl_usd,
       {number(Q("SUM(gain)", "SUM(rows_)", 2, 10), 2)} AS avg_pnl_per_day
FROM known JOIN roll USING (portfolio_id)
GROUP BY user_id, name, region, risk_profile HAVING SUM(gain) < -1000 AND SUM(trades) > 10
ORDER BY total_pnl_usd, user_id LIMIT 30""", ctes=[pnl_roll(30)])
    o["risk_mismatch"] = q(f"""
SELECT user_id, name, risk_profile AS declared_profile,
       (SELECT arg_max(label, rank) FROM (VALUES
            (0, -1, -1, 'Conservative'), (1, 5, 10000, 'Moderate'), (2, 10, 30000, 'Aggressive'),
            (3, 15, 50000, 'Very Aggressive')) AS step(rank, above_symbols, above_usd, label)
        WHERE symbols > above_symbols AND volume > above_usd) AS actual_behavior,
       symbols AS symbols_traded, {R("volume", 2)} AS total_volume_usd,
       CAST(trades AS BIGINT) AS total_trades
FROM known JOIN roll USING (portfolio_id)
JOIN (VALUES ('conservative', 30000), ('moderate', 50000)) AS allowed(profile, usd)
  ON profile = risk_profile AND volume > usd""", ctes=[pnl_roll(30)])
    return o


def oracle_queries() -> dict[str, str]:
    return _layers() | _reports()
