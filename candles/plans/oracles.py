"""DuckDB SQL for the registered queries, written from the definitions of the operators.

Each text runs over the whole tables. `bars`, `ticks`, `listing` and `reports` are common
table expressions with the same meaning as in `candles.sources.tables`.
"""

from __future__ import annotations

BARS = """
bars as (
  select symbol, '1D' as "interval", trade_date,
         max(case when rn = 1 then px end) as open, max(px) as high, min(px) as low,
         max(case when rd = 1 then px end) as close, cast(sum(qty) as bigint) as volume
  from (select concat('S', cast(l_suppkey as varchar)) as symbol,
               cast(l_shipdate as date) as trade_date,
               cast(round(l_extendedprice * 100) as bigint) as px,
               cast(l_quantity as bigint) as qty,
               row_number() over (partition by l_suppkey, l_shipdate
                 order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) as rn,
               row_number() over (partition by l_suppkey, l_shipdate
                 order by l_orderkey desc, l_linenumber desc, l_partkey desc,
                          l_extendedprice desc, l_quantity desc) as rd
        from lineitem) t
  group by symbol, trade_date)"""

TICKS = """
ticks as (
  select event_type as symbol, ts, event_id, cast(round(value * 100) as bigint) as price,
         cast(props->>'$.k' as bigint) as volume
  from events)"""

LISTING = """
listing as (
  select concat('S', cast(s_suppkey as varchar)) as symbol,
         case s_nationkey % 3 when 0 then 'HOSE' when 1 then 'HNX' else 'UPCOM' end as exchange,
         s_name as company_name
  from supplier)"""

REPORTS = """
reports as (
  select concat('C', cast(o_custkey as varchar)) as symbol,
         case o_orderkey % 3 when 0 then 'BalanceSheet' when 1 then 'IncomeStatement'
              else 'CashFlow' end as report_type,
         case o_orderkey % 2 when 0 then 'year' else 'quarter' end as period,
         cast(o_orderdate as date) as period_end, o_orderkey as report_id,
         cast(round(o_totalprice * 100) as bigint) as amount
  from orders)"""

# Every bar with its position, its predecessor, its change and its return.
STEPS = BARS + """,
steps0 as (
  select *, row_number() over w as n, lag(close) over w as prev
  from bars window w as (partition by symbol order by trade_date)),
steps as (
  select *,
         case when n = 1 then 0 else close - prev end as change,
         case when n = 1 then 0.0
              else cast(close - prev as double) / nullif(prev, 0) * 100 end as ret
  from steps0)"""

INDEX_NAMES = """case symbol when 'S1' then 'VNINDEX' when 'S2' then 'HNX-INDEX' else symbol end"""
BAR_COLUMNS = 'symbol, "interval", trade_date, open, high, low, close, volume'
DOUBLES = ", ".join(f"cast({c} as double) as {c}" for c in ("open", "high", "low", "close"))


def r(expression: str, digits: int = 4) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits}"


def w(body: str, *views: str) -> str:
    return "with recursive " + ",".join(views) + body


def last(n: int) -> str:
    return f"over (partition by symbol order by trade_date rows between {n - 1} preceding and current row)"


RUNNING = "over (partition by symbol order by trade_date rows between unbounded preceding and current row)"


def sma(n: int) -> str:
    return f"case when n >= {n} then sum(close) {last(n)} / {n}.0 end"


def band(sign: str) -> str:
    return f"case when n >= 30 then avg(close) {last(30)} {sign} 2 * stddev_pop(close) {last(30)} end"


VWAP = f"sum(cast(close as double) * volume) {RUNNING} / greatest(sum(volume) {RUNNING}, 1)"
RSI = (
    f"case when n >= 14 then 100 - 100 / (1 + (sum(greatest(change, 0)) {last(14)} / 14.0)"
    f" / greatest(sum(greatest(-change, 0)) {last(14)} / 14.0, 1e-8)) end"
)


def per_bar(expression: str, name: str, digits: int = 4) -> str:
    return w(f" select symbol, trade_date, {r(expression, digits)} as {name} from steps", STEPS)


def recursive_ema(select: str) -> str:
    """Walk every series bar by bar; `select` picks from `walk`."""
    return w(f""",
numbered as materialized (select symbol, trade_date, cast(close as double) as close, n from steps),
walk as (
  select symbol, trade_date, n, close as e12, close as e26, cast(0 as double) as sig
  from numbered where n = 1
  union all
  select c.symbol, c.trade_date, c.n,
         c.close * (2.0 / 13) + p.e12 * (11.0 / 13),
         c.close * (2.0 / 27) + p.e26 * (25.0 / 27),
         ((c.close * (2.0 / 13) + p.e12 * (11.0 / 13)) - (c.close * (2.0 / 27) + p.e26 * (25.0 / 27))) * 0.2
           + p.sig * 0.8
  from walk p join numbered c on c.symbol = p.symbol and c.n = p.n + 1)
{select}""", STEPS)


def candle_sql(width: str) -> str:
    return w(f"""
select symbol, time_bucket(interval {width}, ts) as bucket,
       arg_min(price, (ts, event_id)) as open, max(price) as high, min(price) as low,
       arg_max(price, (ts, event_id)) as close, cast(sum(volume) as bigint) as volume
from ticks group by all""", TICKS)


def resample_sql(label: str) -> str:
    return w(f"""
select symbol, cast({label} as date) as period_end, arg_min(open, trade_date) as open,
       max(high) as high, min(low) as low, arg_max(close, trade_date) as close,
       cast(sum(volume) as bigint) as volume
from bars group by 1, 2""", BARS)


def movers(value: str, direction: str) -> str:
    return w(f""",
newest as (
  select symbol, {value} as value,
         row_number() over (partition by symbol order by trade_date desc) as back
  from steps where trade_date = (select max(trade_date) from bars)),
ranked as (
  select row_number() over (order by value {direction}, symbol) as rank, symbol, value
  from newest where back = 1 and value is not null)
select rank, symbol, {r('value')} as value from ranked where rank <= 10""", STEPS)


# The label needs the following bar.
LABELS = BARS + """,
labels_ as (
  select *, lead(close) over w as close_next, lead(trade_date) over w as next_date
  from bars window w as (partition by symbol order by trade_date)),
train as (select * from labels_ where close_next is not null and trade_date < date '2000-01-01'),
test as (select * from labels_ where close_next is not null and trade_date >= date '2000-01-01')"""


ORACLES: dict[str, str] = {
    "scan_bars": w(f" select {BAR_COLUMNS} from bars", BARS),
    "history_range": w(f""" select {BAR_COLUMNS} from bars
where symbol = 'S1' and trade_date >= date '1996-01-01' and trade_date < date '1997-01-01'""", BARS),
    "history_range_all": w(f""" select {BAR_COLUMNS} from bars
where trade_date >= date '1996-01-01' and trade_date < date '1997-01-01'""", BARS),
    "intraday_page": w(""",
page as (select *, row_number() over (partition by symbol order by ts, event_id) as nth from ticks
         where cast(ts as date) = date '2024-01-05')
select symbol, ts, price, volume from page where nth <= 20""", TICKS),
    "distinct_symbols": w(" select distinct symbol from bars", BARS),
    "symbol_subset": w(" select symbol, count(*) as n from bars where symbol in ('S1', 'S3', 'S5') group by 1", BARS),
    "index_allowlist": w(f""" select * from (select {INDEX_NAMES} as symbol, trade_date, close from bars)
where symbol in ('VNINDEX', 'HNX-INDEX', 'UPCOM-INDEX')""", BARS),
    "latest_per_symbol": w(" select symbol, max(trade_date) as latest_date from bars group by 1", BARS),
    "latest_row": w(f""" select {BAR_COLUMNS} from bars b
where trade_date = (select max(trade_date) from bars x where x.symbol = b.symbol)""", BARS),
    "clean_symbol": w(" select upper(symbol) as symbol, count(*) as n from listing group by 1", LISTING),
    "row_key": w(""" select symbol, trade_date,
  symbol || '_1D_' || cast(trade_date as varchar) as daily_key,
  symbol || '_' || cast(trade_date as varchar) as analyst_key from bars""", BARS),
    "daily_view": w(f""" select {BAR_COLUMNS},
  symbol || '_' || "interval" || '_' || cast(trade_date as varchar) as es_id from bars""", BARS),
    "vwap_running": per_bar(VWAP, "vwap"),
    **{k: per_bar(sma(n), "ma") for k, n in (("ma7", 7), ("ma30", 30), ("sma20", 20), ("sma50", 50))},
    "bollinger30": w(f""" select symbol, trade_date, {r(sma(30))} as middle,
  {r(band('+'))} as upper, {r(band('-'))} as lower from steps""", STEPS),
    "daily_return": per_bar("ret", "value"),
    "cumulative_return": per_bar(f"avg(ret) {RUNNING}", "value"),
    "compound_return": per_bar(
        f"(close - first_value(close) {RUNNING}) / cast(nullif(first_value(close) {RUNNING}, 0) as double) * 100",
        "value",
    ),
    "rsi14": per_bar(RSI, "rsi14"),
    "indicators_all": w(f""" select symbol, trade_date, open, high, low, close, volume,
  symbol || '_' || "interval" || '_' || cast(trade_date as varchar) as es_id,
  {r(VWAP)} as vwap, {r(sma(7))} as ma7, {r(sma(30))} as ma30,
  {r(band('+'))} as bollinger_upper, {r(band('-'))} as bollinger_lower,
  {r('ret')} as daily_return, {r(f'avg(ret) {RUNNING}')} as cumulative_return, {r(RSI)} as rsi14
from steps""", STEPS),
    "ema_one_step": per_bar("close * (2.0 / 6) + prev * (1 - 2.0 / 6)", "ema"),
    "ema12": recursive_ema(f"select symbol, trade_date, {r('e12')} as ema from walk"),
    "macd": recursive_ema(f"""select symbol, trade_date, {r('e12 - e26', 2)} as macd,
  {r('sig', 2)} as signal, {r('e12 - e26 - sig', 2)} as histogram from walk"""),
    "next_close_label": w(" select symbol, trade_date, close, close_next from labels_ where close_next is not null", LABELS),
    "replay_order": w(""" select row_number() over (partition by symbol order by ts, event_id) as step,
  symbol, event_id from ticks""", TICKS),
    "resample_weekly": resample_sql("date_trunc('week', trade_date) + interval 6 day"),
    "resample_monthly": resample_sql("last_day(trade_date)"),
    "price_summary": w(f""" select symbol, max(high) as max_high, min(low) as min_low,
  {r('avg(volume)')} as avg_volume from bars group by 1""", BARS),
    "index_summary": w(""" select symbol, max(high) as max_high, min(low) as min_low,
  arg_min(close, trade_date) - arg_max(close, trade_date) as close_change from bars group by 1""", BARS),
    "coverage_status": w(""",
wanted as (select symbol from listing union select 'S_MISSING'),
counts as (select symbol, count(*) as n from bars group by 1)
select symbol, coalesce(n, 0) as n, case when n > 0 then 'success' else 'no_data' end as status
from wanted left join counts using (symbol)""", BARS, LISTING),
    "candles_5m": candle_sql("5 minute"),
    "candles_1h": candle_sql("1 hour"),
    "candlestick_1y": w(""" select trade_date, open, high, low, close, volume from bars
where symbol = 'S1' and trade_date > (select max(trade_date) - interval 12 month from bars where symbol = 'S1')""", BARS),
    "candlestick_1y_all": w(""",
ends as (select symbol, max(trade_date) as last_date from bars group by 1)
select symbol, trade_date, open, high, low, close, volume from bars join ends using (symbol)
where trade_date > last_date - interval 12 month""", BARS),
    "search_top10": w(f" select {BAR_COLUMNS} from bars order by trade_date desc, symbol desc limit 10", BARS),
    "top_gain": movers("ret", "desc"),
    "top_lose": movers("ret", "asc"),
    "top_volume": movers("cast(volume as double)", "desc"),
    "flatten_nested": w(f" select {BAR_COLUMNS} from bars", BARS),
    "normalize_date_millis": w(" select symbol, trade_date, cast(trade_date as varchar) as text from bars", BARS),
    "normalize_date_string": w(" select symbol, trade_date from bars", BARS),
    "fill_nulls": w(""" select symbol, trade_date, case when volume % 7 = 0 then 0 else open end as open,
  case when volume % 11 = 0 then 0 else volume end as volume from bars""", BARS),
    "coerce_dates": w(" select symbol, trade_date from bars where volume % 13 <> 0", BARS),
    "event_columns": w(""" select symbol, cast(trade_date as varchar) as event_date,
  cast(trade_date as varchar) || 'T00:00:00Z' as event_time,
  cast(year(trade_date) as integer) as year, cast(month(trade_date) as integer) as month from bars""", BARS),
    "session_filter": w(" select symbol, ts, price from ticks where volume % 17 <> 0 and hour(ts) < 15", TICKS),
    "kafka_envelope": w(""" select symbol as key, symbol, cast(trade_date as varchar) as event_date,
  cast(close as double) as close from bars""", BARS),
    "profile_unpivot": """
select concat('S', cast(s_suppkey as varchar)) as symbol, 's_name' as field, s_name as value from supplier
union all select concat('S', cast(s_suppkey as varchar)), 's_nationkey', cast(s_nationkey as varchar) from supplier
union all select concat('S', cast(s_suppkey as varchar)), 's_acctbal', cast(s_acctbal as varchar) from supplier""",
    "listing_by_exchange": w(" select * from listing where exchange = 'HOSE' order by symbol limit 10", LISTING),
    "listing_all": w(" select * from listing", LISTING),
    "report_head": w(""",
ranked as (select *, row_number() over (partition by symbol, report_type, period
                                        order by period_end desc, report_id desc) as rn from reports)
select symbol, report_type, period, period_end, report_id, rn from ranked where rn <= 3""", REPORTS),
    "union_symbols": w(f""" select symbol, count(*) as n from (
  select symbol from bars union all select {INDEX_NAMES} from bars union all select symbol from bars)
group by 1""", BARS),
    "dedup_latest": w(""" select symbol, trade_date,
  case when volume % 10 = 0 then close + 1 else close end as close from bars""", BARS),
    "completeness_gate": w(" select trade_date, count(*) as n, count(*) >= 5 as ok from bars group by 1", BARS),
    "late_rows": w(" select symbol, count(*) as n from ticks where 2 * volume > 120 group by 1", TICKS),
    "incremental_maxdate": w(""",
stored as (select symbol, max(trade_date) as latest from bars where trade_date < date '2000-01-01' group by 1)
select symbol, trade_date, close from bars left join stored using (symbol)
where latest is null or trade_date > latest""", BARS),
    "incremental_anti": w(" select symbol, trade_date, close from bars where volume % 5 = 0", BARS),
    "analyst_incremental": w(f""",
full_history as (select symbol, trade_date, {r(sma(30))} as ma30, {r(VWAP)} as vwap from steps)
select * from full_history where trade_date >= date '2000-01-01'""", STEPS),
    "upsert_latest": w(""" select symbol, trade_date,
  case when trade_date >= date '1999-07-01' then close + 1 else close end as close from bars""", BARS),
    "land_ohlcv": w(f' select symbol, "interval", trade_date, {DOUBLES}, volume from bars', BARS),
    "land_market": w(f" select {INDEX_NAMES} as index_code, trade_date, {DOUBLES}, volume from bars", BARS),
    "serving_merge": w(""" select symbol, trade_date,
  case when trade_date >= date '2000-01-01' then close + 1 else close end as close,
  case when trade_date >= date '2000-01-01' then 'speed' else 'batch' end as origin from bars""", BARS),
    "csv_roundtrip": w(" select * from listing", LISTING),
    "compaction_preserves_rows": w(" select symbol, trade_date, close from bars", BARS),
    "monthly_partition_counts": w(" select strftime(trade_date, '%Y-%m') as month, count(*) as n from bars group by 1", BARS),
    "ml_split_counts": w(""" select 'train' as split, count(*) as n from train
union all select 'test', count(*) from test""", LABELS),
    "ml_embargo_count": w(""" select symbol, count(*) as n from train
where next_date < date '2000-01-01' group by 1""", LABELS),
    "ols_close": w(f""" select symbol, {r('regr_slope(close_next, close)', 3)} as slope,
  {r('regr_intercept(close_next, close)', 3)} as intercept from train group by 1""", LABELS),
    "naive_rmse": w(f""" select symbol,
  {r('sqrt(avg(cast(close_next - close as double) * (close_next - close)))', 3)} as value from test group by 1""", LABELS),
    "naive_r2": w(f""" select symbol,
  {r('1 - avg(cast(close_next - close as double) * (close_next - close)) / nullif(var_pop(close_next), 0)', 3)} as value
from test group by 1""", LABELS),
    "stream_parse": w(" select symbol, ts, price, volume from ticks", TICKS),
    "stream_ema_upsert": w(f""" select symbol || '_' || cast(ts as varchar) as row_key,
  {r('price * (2.0 / 6) + lag(price) over (partition by symbol order by ts) * (1 - 2.0 / 6)')} as ema
from ticks""", TICKS),
    "stream_dedup": w(" select distinct symbol, ts, event_id from ticks", TICKS),
    "stream_candles_5m": candle_sql("5 minute"),
    "stream_sma20": w(f""",
numbered as (select *, row_number() over (partition by symbol order by ts, event_id) as n from ticks)
select symbol, ts, event_id, {r('''case when n >= 20 then avg(price) over (partition by symbol order by ts, event_id
  rows between 19 preceding and current row) end''')} as value from numbered""", TICKS),
    "stream_rsi14": w(f""",
numbered as (select *, row_number() over (partition by symbol order by ts, event_id) as n,
  coalesce(price - lag(price) over (partition by symbol order by ts, event_id), 0) as change from ticks),
summed as (select *, sum(greatest(change, 0)) over w as gain, sum(greatest(-change, 0)) over w as loss from numbered
  window w as (partition by symbol order by ts, event_id rows between 13 preceding and current row))
select symbol, ts, event_id, {r("case when n >= 14 then 100 - 100 / (1 + (gain / 14.0) / greatest(loss / 14.0, 1e-8)) end")} as value
from summed""", TICKS),
    "stream_ema_stateful": w(f""",
numbered as materialized (select symbol, ts, event_id, cast(price as double) as price,
  row_number() over (partition by symbol order by ts, event_id) as n from ticks),
walk as (
  select symbol, ts, event_id, n, price as e from numbered where n = 1
  union all
  select c.symbol, c.ts, c.event_id, c.n, c.price / 3 + p.e * 2 / 3
  from walk p join numbered c on c.symbol = p.symbol and c.n = p.n + 1)
select symbol, ts, event_id, {r('e')} as value from walk""", TICKS),
}

ORACLES["parse_market_json"] = w(f""",
index_bars as (select *, {INDEX_NAMES} as index_code, volume % 10 = 0 as corrupt from bars)
select case when not corrupt then index_code end as index_code,
  case when not corrupt then trade_date end as trade_date,
  case when not corrupt then cast(open as double) end as open,
  case when not corrupt then cast(high as double) end as high,
  case when not corrupt then cast(low as double) end as low,
  case when not corrupt then cast(close as double) end as close,
  case when not corrupt then volume end as volume,
  case when not corrupt then cast(year(trade_date) as integer) end as year,
  case when not corrupt then cast(month(trade_date) as integer) end as event_month,
  corrupt
from index_bars""", BARS)
ORACLES["parse_ohlcv_json"] = w("""
select case when volume % 10 <> 0 then symbol end as symbol,
  case when volume % 10 <> 0 then "interval" end as "interval",
  case when volume % 10 <> 0 then trade_date end as trade_date,
  case when volume % 10 <> 0 then cast(open as double) end as open,
  case when volume % 10 <> 0 then cast(high as double) end as high,
  case when volume % 10 <> 0 then cast(low as double) end as low,
  case when volume % 10 <> 0 then cast(close as double) end as close,
  case when volume % 10 <> 0 then volume end as volume,
  volume % 10 = 0 as corrupt
from bars""", BARS)
ORACLES["analyst_continued"] = (
    f"select * from ({ORACLES['indicators_all']}) where trade_date >= date '2000-01-01'"
)
ORACLES["profile_event"] = f"select 'fundamental_profile' as event_type, * from ({ORACLES['profile_unpivot']})"

# Daily bars and the weekly ones made of them, as bars of their own.
MIXED = BARS + """,
mixed as (
  select symbol, "interval", trade_date, open, high, low, close, volume from bars
  union all
  select symbol, '1W', cast(date_trunc('week', trade_date) + interval 6 day as date), arg_min(open, trade_date), max(high), min(low),
         arg_max(close, trade_date), cast(sum(volume) as bigint) from bars group by 1, 3)"""
MIXED_TEST = MIXED + """,
labels_ as (
  select *, lead(close) over (partition by symbol, "interval" order by trade_date) as close_next from mixed),
test as (select * from labels_ where close_next is not null and trade_date >= date '2000-01-01')"""
SERIES = 'symbol, "interval"'
ORACLES |= {f"{g}_mixed": ORACLES[g] for g in ("top_gain", "top_lose", "top_volume", "resample_weekly")}
ORACLES |= {
    "latest_per_symbol_mixed": w(f" select {SERIES}, max(trade_date) as latest_date from mixed group by 1, 2", MIXED),
    "latest_row_mixed": w(f""" select {BAR_COLUMNS} from mixed b
where trade_date = (select max(trade_date) from mixed x where x.symbol = b.symbol and x."interval" = b."interval")""", MIXED),
    "price_summary_mixed": w(f""" select {SERIES}, max(high) as max_high, min(low) as min_low,
  {r('avg(volume)')} as avg_volume from mixed group by 1, 2""", MIXED),
    "index_summary_mixed": w(f""" select {SERIES}, max(high) as max_high, min(low) as min_low,
  arg_min(close, trade_date) - arg_max(close, trade_date) as close_change from mixed group by 1, 2""", MIXED),
    "candlestick_mixed": w(f""",
ends as (select {SERIES}, max(trade_date) as last_date from mixed group by 1, 2)
select {BAR_COLUMNS} from mixed join ends using ({SERIES}) where trade_date > last_date - interval 12 month""", MIXED),
    "completeness_mixed": w(' select "interval", trade_date, count(*) as n, count(*) >= 5 as ok from mixed group by 1, 2', MIXED),
    "naive_rmse_mixed": w(f""" select {SERIES},
  {r('sqrt(avg(cast(close_next - close as double) * (close_next - close)))', 3)} as value from test group by 1, 2""", MIXED_TEST),
    "naive_r2_mixed": w(f""" select {SERIES},
  {r('1 - avg(cast(close_next - close as double) * (close_next - close)) / nullif(var_pop(close_next), 0)', 3)} as value
from test group by 1, 2""", MIXED_TEST),
    "parse_partial": w(f""" select symbol, "interval", trade_date, {DOUBLES},
  case when volume % 7 <> 0 then volume end as volume, false as corrupt from bars""", BARS),
    "stream_parse_partial": w(" select symbol, ts, price, case when volume % 7 <> 0 then volume end as volume from ticks", TICKS),
    "land_market_revised": w(f""" select {INDEX_NAMES} as index_code, trade_date, {DOUBLES}, volume,
  '2001-01-02T00:00:00Z' as ingest_time from bars""", BARS),
    "land_intraday": w(" select symbol, ts, price, volume from ticks", TICKS),
    "land_rejected": w(""" select 'landed' as reason, count(*) as n from bars where volume % 10 > 1
union all select 'no date', count(*) from bars where volume % 10 = 1
union all select 'not json', count(*) from (
  select distinct symbol from bars where volume % 10 = 0)""", BARS),
    "upsert_within_batch": w(" select symbol, trade_date, close + 1 as close from bars", BARS),
}
ORACLES["analyst_view_twice"] = ORACLES["indicators_all"]
ORACLES["daily_view_twice"] = w(""" select symbol, trade_date,
  case when trade_date >= date '2000-01-01' then close + 1 else close end as close,
  symbol || '_' || "interval" || '_' || cast(trade_date as varchar) as es_id from bars""", BARS)
ORACLES["ml_forest"] = w(" select 'forest' as model, symbol, count(*) as n, true as beats_mean from test group by symbol", LABELS)


def least_squares() -> str:
    """Residuals of the label after taking out one feature after another, by sums over the training rows."""
    names = ["open", "high", "low", "close", "volume", "y"]
    centred = ", ".join(f"cast({'close_next' if c == 'y' else c} as double) - avg("
                        f"{'close_next' if c == 'y' else c}) filter (where training) over () as {c}" for c in names)
    steps = [f"""
step0 as materialized (
  select training, cast(close_next as double) as label, {centred}
  from (select *, trade_date < date '2000-01-01' as training from labels_ where close_next is not null))"""]
    for i, feature in enumerate(names[:-1]):
        rest = ", ".join(
            f"{c} - {feature} * (sum({c} * {feature}) filter (where training) over ()"
            f" / sum({feature} * {feature}) filter (where training) over ()) as {c}" for c in names[i + 1:])
        steps.append(f"step{i + 1} as materialized (select training, label, {rest} from step{i})")
    return ", ".join(steps)


ORACLES["ml_linear"] = w(f""", {least_squares()},
scores as (select sqrt(avg(y * y)) as rmse, 1 - avg(y * y) / var_pop(label) as r2 from step5 where not training)
select 'linear' as model, 'rmse' as metric, {r('rmse', 2)} as value from scores
union all select 'linear', 'r2', {r('r2', 2)} from scores""", LABELS)


# Bars without those of a week and of a day, and the days on which the market should have traded.
CALENDAR = BARS + """,
held as (
  select * from bars where trade_date not between date '1996-03-04' and date '1996-03-10' and trade_date <> date '1997-07-01'),
every as (
  select cast(unnest(generate_series(min(trade_date), max(trade_date), interval 1 day)) as date) as trade_date from held),
flagged as (
  select trade_date, trade_date in (select trade_date from held) as traded from every),
calendar as materialized (
  select trade_date, row_number() over (order by trade_date) as place
  from (select *, avg(case when traded then 1.0 else 0.0 end) over (partition by isodow(trade_date)) as share from flagged)
  where traded or share >= 0.5),
steps as materialized (
  select symbol, place, lead(place) over (partition by symbol order by place) as after from held join calendar using (trade_date))"""
ORACLES |= {
    "completeness_calendar": w(""" select trade_date, count(close) as n, count(close) >= 5 as ok
from calendar left join held using (trade_date) group by 1""", CALENDAR),
    "missing_days": w(""" select symbol, c.trade_date
from (select symbol, unnest(range(place + 1, after)) as place from steps where after > place + 1) join calendar c using (place)""", CALENDAR),
    "outage_islands": w(""" select symbol, a.trade_date as first_day, b.trade_date as last_day, after - steps.place - 1 as days
from steps join calendar a on a.place = steps.place + 1 join calendar b on b.place = after - 1 where after - steps.place - 1 >= 5""", CALENDAR),
    "land_intraday_untimed": w(""" select symbol, cast(ts as date) as trade_date, price, volume,
  '2024-02-02T08:00:00Z' as event_time from ticks""", TICKS),
    "daily_view_intraday": w(""" select symbol, ts, price, volume,
  symbol || '_1m_' || case when ts = date_trunc('second', ts) then strftime(ts, '%Y-%m-%d %H:%M:%S')
    else rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') end as es_id from ticks""", TICKS),
    "analyst_intraday": w(f""",
numbered as (
  select *, row_number() over x as n, lag(price) over x as prev from ticks window x as (partition by symbol order by ts)),
changes as (select *, case when n = 1 then 0 else price - prev end as change,
  cast(price - prev as double) / nullif(prev, 0) * 100 as ret from numbered)
select symbol, ts, symbol || '_1m_' || case when ts = date_trunc('second', ts) then strftime(ts, '%Y-%m-%d %H:%M:%S')
    else rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') end as es_id,
  {r('sum(cast(price as double) * volume) over a / greatest(sum(volume) over a, 1)')} as vwap,
  {r('case when n >= 30 then avg(price) over (partition by symbol order by ts rows between 29 preceding and current row) end')} as ma30,
  {r('case when n = 1 then 0.0 else ret end')} as daily_return,
  {r("""case when n >= 14 then 100 - 100 / (1 + (sum(greatest(change, 0)) over b / 14.0)
    / greatest(sum(greatest(-change, 0)) over b / 14.0, 1e-8)) end""")} as rsi14
from changes
window a as (partition by symbol order by ts rows unbounded preceding),
       b as (partition by symbol order by ts rows between 13 preceding and current row)""", TICKS),
}
ORACLES["analyst_corrected"] = ORACLES["indicators_all"]


def rollup_sql(width: str, name: str) -> str:
    candle = f"""select symbol, time_bucket(interval {width}, ts) as bucket, arg_min(price, (ts, event_id)) as open,
  max(price) as high, min(price) as low, arg_max(price, (ts, event_id)) as close, cast(sum(volume) as bigint) as volume
from ticks group by all"""
    return f"""
select symbol, bucket, open, high, low, close, volume, true as traded, '{name}' as width from ({candle})
union all
select symbol, unnest(generate_series(bucket + interval {width}, after - interval {width}, interval {width})), close, close, close,
  close, 0, false, '{name}'
from (select *, lead(bucket) over (partition by symbol order by bucket) as after from ({candle})) where after > bucket + interval {width}"""


ORACLES["candles_rollup"] = w(" union all ".join(
    rollup_sql(width, name) for width, name in (("1 minute", "1 minute"), ("5 minute", "5 minutes"), ("1 hour", "1 hour"), ("1 day", "1 day"))), TICKS)

ORACLES |= {
    "search_early": ORACLES["search_top10"],
    "serving_covered": ORACLES["serving_merge"],
    "ols_walk_forward": w(f""",
pairs as (
  select symbol, trade_date, cast(close as double) as y, cast(lag(close) over (partition by symbol order by trade_date) as double) as x
  from bars),
fitted as (
  select symbol, trade_date, count(x) over k as n, regr_slope(y, x) over k as b, regr_intercept(y, x) over k as a from pairs
  window k as (partition by symbol order by trade_date rows unbounded preceding))
select symbol, trade_date, {r('case when n >= 2 and isfinite(b) then b end')} as slope,
  {r('case when n >= 2 and isfinite(b) then a end', 1)} as intercept from fitted""", BARS),
}

ORACLES |= {
    "compaction_packed": ORACLES["compaction_preserves_rows"],
    "late_quantiles": w(f""",
buckets as (
  select symbol, date_trunc('hour', ts) as hour, case when volume > 0 then ceil(ln(120.0 * volume) / ln(1.01 / 0.99)) end as bucket, count(*) as n
  from ticks group by 1, 2, 3),
ranked as (
  select *, sum(n) over (partition by symbol, hour) as total,
    sum(n) over (partition by symbol, hour order by bucket nulls first rows unbounded preceding) as upto from buckets)
select symbol, hour, cast(max(total) as bigint) as n,
  {r('coalesce(pow(1.01 / 0.99, min(bucket)) * 2 / (1.01 / 0.99 + 1), 0)', 3)} as p99
from ranked where upto >= ceil(total * 0.99) group by 1, 2""", TICKS),
}
ORACLES["chart_skipped"] = w(""" select trade_date, open, high, low, close, volume from bars
where symbol = 'S1' and trade_date > date '1998-06-30' - interval 12 month and trade_date <= date '1998-06-30'""", BARS)
