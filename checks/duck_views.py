"""The domain views and shared intermediate results as DuckDB SQL."""

from __future__ import annotations

PARTS: dict[str, str] = {}


def part(name: str, text: str) -> None:
    PARTS[name] = text


def symbol(key: str) -> str:
    return (
        f"(CASE WHEN {key} % 10 < 3 THEN 'sh6' WHEN {key} % 10 < 6 THEN 'sz0' "
        f"WHEN {key} % 10 < 9 THEN 'sz3' WHEN {key} % 20 = 9 THEN 'sh5' ELSE 'sz1' END || "
        f"CASE WHEN {key} < 100000 THEN lpad(CAST({key} AS VARCHAR), 5, '0') "
        f"ELSE CAST({key} AS VARCHAR) END)"
    )


def quarter_day(day: str) -> str:
    return f"last_day(make_date(year({day}), quarter({day}) * 3, 1))"


def sum_if(condition: str, value: str) -> str:
    return f"coalesce(sum({value}) FILTER ({condition}), 0)"


def dec4(x: str) -> str:
    units = f"CAST(floor(CAST({x} AS DOUBLE) * 1e4 + 0.500001e0) AS DECIMAL(18,0))"
    return f"CAST({units} * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4))"


def relist(bare: str) -> str:
    """Exchange from the first digit of a bare code."""
    return f"(CASE WHEN left({bare}, 1) IN ('6', '9', '5') THEN 'sh' ELSE 'sz' END || {bare})"


def bare(key: str) -> str:
    return f"substr({symbol(key)}, 3)"


part("trades", """
SELECT l_suppkey AS suppkey, CAST(l_shipdate AS DATE) AS day, l_partkey AS partkey,
       l_orderkey AS orderkey, l_linenumber AS linenumber, CAST(l_quantity AS BIGINT) AS qty,
       l_returnflag AS flag, l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(10,2)) AS ep,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS net,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS gross,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS cut,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS fee
FROM lineitem
""")

part("bars", f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       first(ep ORDER BY orderkey, linenumber, ep) AS open, CAST(max(gross) AS DECIMAL(10,2)) AS high,
       CAST(min(net) AS DECIMAL(10,2)) AS low,
       CAST(last(net + fee ORDER BY orderkey, linenumber, ep) AS DECIMAL(10,2)) AS close,
       CAST(sum(qty) * 100 AS BIGINT) AS volume, CAST(sum(ep) AS DECIMAL(18,2)) AS amount
FROM trades GROUP BY suppkey, day
""")

part("quarters", f"""
SELECT *, revenue - cost - returned AS profit, qty * 1000 AS stock, done_cut * 3 AS payable FROM (
  SELECT suppkey, {quarter_day("day")} AS report_date, sum(net) AS revenue,
         sum(cut) * 5 + sum(fee) * 4 AS cost, {sum_if("flag = 'R'", "ep")} AS returned,
         sum(fee) AS fees, sum(cut) AS cuts, sum(ep) AS listed,
         {sum_if("status = 'F'", "net")} AS cash_in, {sum_if("status = 'O'", "cut")} AS cash_out,
         {sum_if("flag = 'N'", "fee")} AS interest, {sum_if("status = 'O'", "net")} AS open_net,
         {sum_if("status = 'F'", "cut")} AS done_cut, CAST(sum(qty) AS BIGINT) AS qty
  FROM trades GROUP BY suppkey, {quarter_day("day")})
""")

part("levels", """
SELECT *, stock + open_net + fees AS cur_assets, payable + cuts AS cur_debts,
       stock + open_net + fees + listed * 2 AS assets,
       payable + cuts + cuts * CASE WHEN suppkey % 17 = 1 THEN 40 ELSE 2 END AS debts
FROM quarters
""")


def _ytd(x: str) -> str:
    return (
        f"CAST(sum({x}) OVER (PARTITION BY suppkey, year(report_date) ORDER BY report_date) "
        "AS DECIMAL(18,2))"
    )


part("statements", f"""
SELECT *, CAST(CAST(floor(CAST(net_profit AS DOUBLE) / 100) AS DECIMAL(18,0))
              * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS eps FROM (
  SELECT {symbol("suppkey")} AS stock_code, report_date, '合并期末' AS report_type,
         {_ytd("revenue")} AS total_revenue, {_ytd("profit")} AS net_profit,
         CAST(assets AS DECIMAL(18,2)) AS total_assets, CAST(debts AS DECIMAL(18,2)) AS total_liabilities,
         {_ytd("cash_in - cash_out")} AS operating_cash_flow,
         CAST(CASE WHEN suppkey % 7 <> 0 THEN assets - debts END AS DECIMAL(18,2)) AS equity_parent,
         CASE WHEN suppkey % 11 <> 10 THEN report_date + CAST(20 + suppkey % 40 +
           CASE WHEN suppkey % 5 = 0 AND quarter(report_date) = 3 THEN 200 ELSE 0 END AS INTEGER) END AS announcement_date,
         {_ytd("cost")} AS operating_cost, {_ytd("profit - fees")} AS net_profit_deducted,
         CAST(stock AS DECIMAL(18,2)) AS inventory, CAST(open_net AS DECIMAL(18,2)) AS accounts_receivable,
         CAST(payable AS DECIMAL(18,2)) AS accounts_payable, {_ytd("cuts")} AS capex,
         {_ytd("interest")} AS interest_expense, CAST(cur_assets AS DECIMAL(18,2)) AS current_assets,
         CAST(cur_debts AS DECIMAL(18,2)) AS current_liabilities,
         CAST(fees + cash_in AS DECIMAL(18,2)) AS monetary_funds
  FROM levels)
""")

part("capital", f"""
SELECT {symbol("s_suppkey")} AS stock_code, d AS record_date,
       CASE WHEN d = DATE '1999-06-30' AND base > 0 THEN base + s_suppkey % 3 * 500 ELSE base END AS total_shares
FROM (SELECT s_suppkey, CAST(floor(greatest(s_acctbal, 0)) AS BIGINT) AS base,
             unnest([DATE '1995-01-01', DATE '1999-06-30']) AS d FROM supplier)
""")

part("shares", "SELECT stock_code, arg_max(total_shares, record_date) AS total_shares FROM capital GROUP BY stock_code")

part("dividends", f"""
SELECT {symbol("suppkey")} AS stock_code, day AS dividend_date,
       CAST(CAST(floor(sum(fee)) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS cash_per_share,
       day - 30 AS announcement_date
FROM trades WHERE flag = 'R' GROUP BY suppkey, day
""")

part("master", f"""
SELECT stock_code, s_name AS stock_name, n_name || ' / ' || s_name AS stock_name_cn,
       upper(left(stock_code, 2)) AS market, CASE WHEN fund THEN 'ETF' ELSE n_name END AS board,
       CASE WHEN NOT fund THEN DATE '1990-01-01' + s_nationkey * 30 END AS listing_date,
       '正常' AS status, fund AS is_etf
FROM (SELECT *, {symbol("s_suppkey")} AS stock_code, s_suppkey % 10 = 9 AS fund FROM supplier)
JOIN nation ON s_nationkey = n_nationkey
""")

part("industry", f"""
SELECT {symbol("s_suppkey")} AS stock_code, CASE WHEN n_nationkey <> 24 THEN n_name END AS industry_name,
       r_name AS industry_level, 'view' AS source,
       DATE '2000-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS update_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

_SIGNED = "CASE WHEN flag = 'R' THEN -ep ELSE ep END"
part("capital_flow", f"""
SELECT *, {", ".join(f"{dec4(f'CAST({n}_net_amount AS DOUBLE) / CAST(traded AS DOUBLE) * 100')} AS {n}_net_ratio"
                     for n in ("main", "xlarge", "large", "medium", "small"))}
FROM (SELECT *, xlarge_net_amount + large_net_amount AS main_net_amount FROM (
  SELECT {symbol("suppkey")} AS stock_code, day AS trade_date, sum(ep) AS traded,
         {sum_if("qty >= 40", _SIGNED)} AS xlarge_net_amount,
         {sum_if("qty >= 25 AND qty < 40", _SIGNED)} AS large_net_amount,
         {sum_if("qty >= 10 AND qty < 25", _SIGNED)} AS medium_net_amount,
         {sum_if("qty < 10", _SIGNED)} AS small_net_amount
  FROM trades GROUP BY suppkey, day))
""")

part("margin_legs", f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       sum(ep) FILTER (status = 'O') AS rz_balance, sum(ep) FILTER (status = 'F') AS rq_balance
FROM trades GROUP BY suppkey, day
""")

part("northbound_rows", f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       {sum_if("flag = 'A'", "net")} - {sum_if("flag = 'R'", "net")} AS net_inflow,
       CAST(sum(qty) AS BIGINT) AS holding_shares, sum(gross) AS holding_value,
       {dec4("CAST(sum(qty) AS DOUBLE) / 500")} AS holding_ratio
FROM trades GROUP BY suppkey, day
""")

part("northbound_market", f"""
SELECT *, buy_amount - sell_amount AS net_buy_amount,
       sum(buy_amount - sell_amount) OVER (ORDER BY trade_date) AS cumulative_net_buy,
       buy_amount - sell_amount + daily_balance AS daily_inflow
FROM (SELECT day AS trade_date, {sum_if("flag = 'A'", "net")} AS buy_amount,
             {sum_if("flag = 'R'", "net")} AS sell_amount, sum(fee) AS daily_balance,
             sum(gross) AS holding_market_value FROM trades GROUP BY day)
""")

part("announcements", f"""
SELECT {symbol("o_custkey")} AS stock_code, CAST(o_orderdate AS DATE) AS announcement_date,
       o_orderpriority || ' notice ' || CAST(o_orderkey AS VARCHAR) AS title,
       '/notices/' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS pdf_url, o_orderstatus AS announcement_type
FROM orders
""")

part("update_log", f"""
SELECT {symbol("suppkey")} AS stock_code, data_type,
       CASE WHEN data_type = 'margin' THEN last + CAST(suppkey % 4 AS INTEGER) - 1 ELSE last END AS last_update_date
FROM (SELECT suppkey, last, unnest(['margin', 'daily']) AS data_type
      FROM (SELECT suppkey, max(day) AS last FROM trades GROUP BY suppkey))
""")

# --- risk tables, straight from the typed values ------------------------------------------------

part("risk_pledge", f"""
SELECT {relist(bare("suppkey"))} AS stock_code, day AS trade_date,
       CASE WHEN qty <> 50 THEN CAST(CAST(qty / 4 AS DECIMAL(18,2)) AS DOUBLE) END AS pledge_ratio,
       qty * 130 AS pledge_shares, CAST(ep AS DOUBLE) * 10000 AS pledge_market_value, n AS pledge_count
FROM (SELECT suppkey, day, CAST(sum(qty) AS BIGINT) AS qty, sum(ep) AS ep, count(*) AS n
      FROM trades WHERE dayofweek(day) = 5 GROUP BY suppkey, day)
""")

part("risk_holder_change", f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY stock_code, announcement_date, holder_name, change_type, change_shares
           ORDER BY change_ratio DESC, hold_after_shares DESC, change_start_date DESC) AS place
  FROM (SELECT {relist(bare("suppkey"))} AS stock_code, day AS announcement_date,
               'holder ' || CAST(partkey AS VARCHAR) AS holder_name,
               CASE flag WHEN 'A' THEN '增持' ELSE '减持' END AS change_type,
               CAST(ep * 10000 AS BIGINT) AS change_shares, CAST(qty AS DOUBLE) / 10 AS change_ratio,
               CAST(gross * 10000 AS BIGINT) AS hold_after_shares, day - 10 AS change_start_date
        FROM trades WHERE flag IN ('A', 'R') AND qty NOT IN (1, 7, 13)))
WHERE place = 1
""")

part("risk_buyback", f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY stock_code, announcement_date, progress
           ORDER BY shares_lower DESC) AS place
  FROM (SELECT {relist(bare("o_custkey"))} AS stock_code, CAST(o_orderdate AS DATE) AS announcement_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN '实施中' WHEN '2-HIGH' THEN '董事会预案'
                    WHEN '3-MEDIUM' THEN '股东大会通过' WHEN '4-NOT SPECIFIED' THEN '完成实施' END AS progress,
               CAST(o_orderdate AS DATE) AS plan_start_date, o_orderkey AS shares_lower,
               o_orderkey + 10 AS shares_upper, CAST(o_totalprice AS DECIMAL(12,2)) AS amount_lower,
               CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS amount_upper, o_custkey AS done_shares,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS done_amount
        FROM orders WHERE o_orderpriority <> '5-LOW'))
WHERE place = 1
""")

part("risk_unlock", f"""
SELECT {relist(bare("suppkey"))} AS stock_code, day AS free_date, 'lot ' || flag AS free_type,
       CAST(sum(qty) * 1000 AS BIGINT) AS free_shares,
       CAST(CASE WHEN sum(qty) = 30 THEN 0 ELSE sum(qty) FILTER (status = 'F') * 900 END AS BIGINT) AS actual_free_shares,
       sum(ep) FILTER (status = 'F') AS actual_free_value,
       CAST(sum(qty) AS DOUBLE) / 1000 AS ratio_to_float, max(ep) AS close_before
FROM trades WHERE day BETWEEN DATE '2000-03-31' - 730 AND DATE '2000-03-31' + 365
GROUP BY suppkey, day, flag
""")

part("risk_holder_num", f"""
SELECT {relist(bare("suppkey"))} AS stock_code, d AS stat_date, n AS holder_num, prev AS holder_num_prev,
       n - prev AS holder_num_change, {dec4("CAST(n - prev AS DOUBLE) / prev * 100")} AS change_ratio,
       value AS avg_mktcap, n * 100 AS total_shares, d + 15 AS notice_date
FROM (SELECT *, lag(n) OVER (PARTITION BY suppkey ORDER BY d) AS prev
      FROM (SELECT suppkey, {quarter_day("day")} AS d, CAST(sum(qty) AS BIGINT) AS n, sum(ep) AS value
            FROM trades GROUP BY suppkey, {quarter_day("day")}))
""")

SEAT_REASON = """CASE WHEN qty = 50 THEN '上榜' ELSE
        'cumulative deviation over three consecutive days, class ' || flag || ' band ' || status END"""

part("top_list", f"""
SELECT {relist(bare("suppkey"))} AS stock_code, day AS trade_date, reason AS list_type, reason,
       gross AS buy_amount, net AS sell_amount, gross - net AS net_amount, orderkey, linenumber, ep, flag, status
FROM (SELECT *, {SEAT_REASON} AS reason FROM trades WHERE qty >= 30)
""")

part("dragon_tiger", """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY stock_code, trade_date, list_type
    ORDER BY orderkey DESC, linenumber DESC, ep DESC, buy_amount DESC, sell_amount DESC, flag DESC, status DESC) AS place
  FROM top_list) WHERE place = 1
""")

# --- derived tables ------------------------------------------------------------------------------

W = "OVER (PARTITION BY stock_code ORDER BY trade_date)"


def rows(call: str, n: int) -> str:
    return (
        f"{call} OVER (PARTITION BY stock_code ORDER BY trade_date "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    )


part("bar_doubles", """
SELECT stock_code, trade_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
       CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume FROM bars
""")

part("daily_basic", f"""
SELECT stock_code, trade_date, prev_close, (close - prev_close) / nullif(prev_close, 0) * 100 AS change_pct,
       (high - low) / nullif(prev_close, 0) * 100 AS amplitude, abs(close - open) AS body_size,
       high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow,
       high_20, low_20, high_60, low_60
FROM (SELECT *, lag(close) {W} AS prev_close,
             {", ".join(f"{rows('max(high)', n)} AS high_{n}, {rows('min(low)', n)} AS low_{n}" for n in (20, 60))}
      FROM bar_doubles)
""")

part("stock_daily", """
SELECT b.*, d.* EXCLUDE (stock_code, trade_date), nullif(s.total_shares, 0) AS outstanding_share,
       round(CAST(b.volume AS DOUBLE) / nullif(s.total_shares, 0) * 100, 6) AS turnover, NULL AS adjust_factor
FROM bars b JOIN daily_basic d ON b.stock_code = d.stock_code AND b.trade_date = d.trade_date
LEFT JOIN shares s ON b.stock_code = s.stock_code
""")

part("tech_steps", f"""
SELECT *, CASE WHEN close > pc THEN close - pc ELSE 0 END AS gain, CASE WHEN close < pc THEN pc - close ELSE 0 END AS loss,
       greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
       CASE WHEN tp > ptp THEN tp * volume ELSE 0 END AS fu, CASE WHEN tp < ptp THEN tp * volume ELSE 0 END AS fd,
       CASE WHEN close > pc THEN volume ELSE 0 END AS vu, CASE WHEN close < pc THEN volume ELSE 0 END AS vd,
       CASE WHEN close = pc THEN volume ELSE 0 END AS vf,
       CASE WHEN ph IS NOT NULL THEN greatest(high - ph, 0) END AS up_move,
       CASE WHEN pl IS NOT NULL THEN greatest(pl - low, 0) END AS down_move
FROM (SELECT *, lag(close) {W} AS pc, lag(high) {W} AS ph, lag(low) {W} AS pl, lag(tp) {W} AS ptp,
             count(*) OVER (PARTITION BY stock_code) AS total
      FROM (SELECT *, (high + low + close) / 3 AS tp FROM bar_doubles))
WHERE total >= 2
""")

_ROLLED = {
    **{f"ma{n}": rows("avg(close)", n) for n in (5, 10, 20, 60)},
    "std20": rows("stddev_samp(close)", 20),
    **{f"{k}{n}": rows(f"avg({k})", n) for k in ("gain", "loss") for n in (6, 12, 24)},
    **{f"low{n}": rows("min(low)", n) for n in (9, 14)},
    **{f"high{n}": rows("max(high)", n) for n in (9, 14)},
    "tpm": rows("avg(tp)", 20),
    "tps": rows("list(tp)", 20),
    "atr14": rows("avg(tr)", 14),
    "vol_ma5": rows("avg(volume)", 5),
    "vol_ma10": rows("avg(volume)", 10),
    "obv": f"sum(vu - vd) {W}",
    **{f"{k}14": rows(f"sum({k})", 14) for k in ("fu", "fd")},
    **{f"{k}24": rows(f"sum({k})", 24) for k in ("vu", "vd", "vf")},
    **{f"{k}14": rows(f"avg({k})", 14) for k in ("up_move", "down_move")},
}
part("tech_rolled", f"""
SELECT *, {", ".join(f"{x} AS {n}" for n, x in _ROLLED.items())} FROM tech_steps
""")

part("tech_base", f"""
SELECT *, ma20 AS boll_mid, ma20 + 2 * std20 AS boll_upper, ma20 - 2 * std20 AS boll_lower,
       {", ".join(f"(close - ma{n}) / nullif(ma{n}, 0) * 100 AS bias{n}" for n in (5, 10, 20, 60))},
       {", ".join(f"100 - 100 / (1 + gain{n} / nullif(loss{n}, 0)) AS rsi{n}" for n in (6, 12, 24))},
       coalesce((close - low9) / nullif(high9 - low9, 0) * 100, 50) AS rsv,
       coalesce((tp - tpm) / nullif(0.015e0 * list_avg(list_transform(tps, lambda v: abs(v - tpm))), 0), 0) AS cci20,
       coalesce((high14 - close) / nullif(high14 - low14, 0) * 100, 50) AS wr14,
       coalesce(100 - 100 / (1 + fu14 / nullif(fd14, 0)), 50) AS mfi14,
       coalesce((vu24 + vf24 / 2) / nullif(vd24 + vf24 / 2, 0) * 100, 100) AS vr,
       100 * up_move14 / nullif(atr14, 0) AS dmi_pdi, 100 * down_move14 / nullif(atr14, 0) AS dmi_mdi,
       coalesce((close - open) / nullif(high - low, 0) * volume, 0) AS wvad
FROM tech_rolled
""")

part("technical_rolling", f"""
SELECT *, {rows("avg(pair)", 2)} AS dmi_adxr FROM (
  SELECT *, dmi_adx + lag(dmi_adx, 14) {W} AS pair FROM (
    SELECT *, {rows("avg(dx)", 14)} AS dmi_adx FROM (
      SELECT *, 100 * abs(dmi_pdi - dmi_mdi) / nullif(dmi_pdi + dmi_mdi, 0) AS dx FROM tech_base)))
""")

part("fold_rows", "SELECT stock_code, trade_date, close, high, low, rsv, row_number() OVER (PARTITION BY stock_code ORDER BY trade_date) AS n FROM tech_base")

_K, _D = "k * 2 / 3 + s.rsv / 3", "d * 2 / 3 + (k * 2 / 3 + s.rsv / 3) / 3"
_E12, _E26 = "e12 * 11 / 13 + s.close * 2 / 13", "e26 * 25 / 27 + s.close * 2 / 27"
_NEXT = "sar + speed * (extreme - sar)"
_CROSS = f"CASE WHEN rising THEN s.low < {_NEXT} ELSE s.high > {_NEXT} END"
_FURTHER = "CASE WHEN rising THEN s.high > extreme ELSE s.low < extreme END"
part("folded", f"""
SELECT stock_code, trade_date, n, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS dea, rsv AS k, rsv AS d,
       low AS sar, high AS extreme, true AS rising, 0.02e0 AS speed FROM fold_rows WHERE n = 1
UNION ALL -- step
SELECT s.stock_code, s.trade_date, s.n, {_E12}, {_E26}, dea * 0.8e0 + (({_E12}) - ({_E26})) * 0.2e0, {_K}, {_D},
       CASE WHEN {_CROSS} THEN extreme ELSE {_NEXT} END,
       CASE WHEN {_CROSS} THEN CASE WHEN rising THEN s.low ELSE s.high END
            WHEN {_FURTHER} THEN CASE WHEN rising THEN s.high ELSE s.low END ELSE extreme END,
       CASE WHEN {_CROSS} THEN NOT rising ELSE rising END,
       CASE WHEN {_CROSS} THEN 0.02e0 WHEN {_FURTHER} THEN least(speed + 0.02e0, 0.2e0) ELSE speed END
FROM folded f JOIN fold_rows s ON s.stock_code = f.stock_code AND s.n = f.n + 1
""")

part("technical_fold", """
SELECT stock_code, trade_date, e12 AS ema12, e26 AS ema26, e12 - e26 AS macd_dif, dea AS macd_dea,
       (e12 - e26 - dea) * 2 AS macd_hist, k AS kdj_k, d AS kdj_d, 3 * k - 2 * d AS kdj_j, sar FROM folded
""")

part("technical_indicators", """
SELECT r.*, f.* EXCLUDE (stock_code, trade_date)
FROM technical_rolling r JOIN technical_fold f ON r.stock_code = f.stock_code AND r.trade_date = f.trade_date
""")
