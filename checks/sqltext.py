"""Common table expressions of the SQL counterparts.

Money is kept in whole cents and scores in ten-thousandths: sums and half-up
rounding are then exact integer arithmetic in any engine.
"""

from __future__ import annotations

WINDOW_MS, GEO_MS = 172_800_000, 21_600_000
AS_OF = "timestamp '2024-01-31 00:00:00'"
NOON = "timestamp '2024-01-30 12:00:00'"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half up, for values that are not negative."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def hashed(value: str, first: int) -> str:
    return f"cast('0x' || substr(md5({value}), {first}, 8) as bigint)"


# The time stamp that replaying a CSV row gives: its hour, and a place in it by md5.
_PAIR = "nameOrig || ':' || nameDest"
_REPLAYED = f"1704067200000 + (step - 1) * 3600000 + {hashed(_PAIR, 1)} % 3600000"

_TX = """tx as (
  select *, cast(round(amount * 100) as bigint) as cents,
    make_timestamp(ingestion_timestamp_ms * 1000) as event_ts,
    strftime(make_timestamp(ingestion_timestamp_ms * 1000), '%Y%m') as ym,
    cast(amount >= 10000 as bigint) as large
  from (
    select event_id as seq, user_id, epoch_us(ts) // 1000 as ingestion_timestamp_ms,
      (epoch_us(ts) // 1000 - 1704067200000) // 3600000 + 1 as step,
      case event_type when 'click' then 'PAYMENT' when 'purchase' then 'TRANSFER'
        when 'view' then 'CASH_OUT' when 'error' then 'DEBIT' else 'CASH_IN' end as type,
      round(value * 100, 2) as amount,
      'C' || user_id as nameOrig,
      'M' || lpad(cast(event_id % 4 as varchar), 2, '0') || event_id as nameDest,
      cast(event_id % 97 = 0 or (value >= 150 and event_id % 3 = 0) as bigint) as isFraud,
      cast(event_type = 'purchase' and value > 200 as bigint) as isFlaggedFraud
    from events)
)"""
_TX_REPLAYED = _TX.replace("  from (\n", f"""  from (select * replace ({_REPLAYED} as ingestion_timestamp_ms) from (
""", 1).replace("    from events)\n)", "    from events))\n)")

_PROF = """prof as (
  select distinct 'C' || user_id as card_id, '202401' as year_month,
    15000.0::double + (user_id % 5) * 5000 as credit_limit,
    2000.0::double + (user_id % 4) * 1000 as avg_amount,
    'M' || lpad(cast(user_id % 4 as varchar), 2, '0') as last_city
  from events where user_id % 10 <> 9
)"""

_BL = """bl as (
  select distinct 'C' || user_id as card_id,
    case when user_id % 25 = 0 then '1' else '0' end as is_active
  from events where user_id % 25 in (0, 1)
)"""


def _feat(window_ms: int) -> str:
    frame = f"(partition by nameOrig order by ingestion_timestamp_ms range between {window_ms} preceding and current row)"
    later = ("(partition by nameOrig, ingestion_timestamp_ms order by seq "
             "rows between 1 following and unbounded following)")
    return f"""feat as (
  select tx.*,
    count(*) over {frame} - count(*) over {later} as n_window,
    cast(sum(large) over {frame} - coalesce(sum(large) over {later}, 0) as bigint) as hv_window,
    cast(sum(cents) over {frame} - coalesce(sum(cents) over {later}, 0) as bigint) as window_cents,
    lag(ingestion_timestamp_ms) over (partition by nameOrig, ym order by ingestion_timestamp_ms, seq) as prev_ts
  from tx
)"""


def _scored(geo_ms: int) -> str:
    return f"""hits as (
  select f.*, b.is_active, p.credit_limit, p.avg_amount, p.last_city,
    coalesce(b.is_active = '1', false) as r1,
    coalesce(p.credit_limit > 0 and amount > p.credit_limit, false) as r2,
    coalesce(p.avg_amount > 0 and amount > 5 * p.avg_amount, false) as r5,
    coalesce(p.last_city not in ('UNKNOWN', substr(nameDest, 1, 3))
      and ingestion_timestamp_ms - coalesce(prev_ts, 0) < {geo_ms}, false) as r3,
    hv_window >= 3 as r4, n_window >= 10 as r6
  from feat f
  left join bl b on b.card_id = f.nameOrig
  left join prof p on p.card_id = f.nameOrig and p.year_month = f.ym
), scored as (
  select *,
    concat_ws(',', case when r1 then 'R1_BLACKLIST' end, case when r2 then 'R2_CREDIT_LIMIT' end,
      case when r5 then 'R5_BEHAVIORAL_ANOMALY' end, case when r3 then 'R3_GEO_VELOCITY' end,
      case when r4 then 'R4_HIGH_VALUE_BURST' end, case when r6 then 'R6_VELOCITY_BURST' end) as rules,
    greatest(0, case when r1 then 10000 end, case when r2 then 9000 end, case when r5 then 7500 end,
      case when r3 then 8500 end, case when r4 then 8000 end, case when r6 then 7000 end) as score_e4
  from hits
), fired as (
  select * from scored where rules <> ''
)"""


_FA = """fa as (
  select seq as alert_id, event_ts as alert_ts, cast(strftime(event_ts, '%Y%m%d') as bigint) as date_key,
    nameOrig as card_id, nameDest as dest_id, type as transaction_type, cents, rules as rules_triggered,
    score_e4, isFraud as is_fraud_label, isFlaggedFraud as is_flagged_fraud,
    case seq % 4 when 1 then 'CONFIRMED_FRAUD' when 2 then 'FALSE_POSITIVE'
      when 3 then 'UNDER_REVIEW' else 'PENDING' end as review_status
  from fired
)"""

_TS = f"""ts as (
  select t.*, coalesce(a.n, 0) as alerts_generated,
    {half_up('100 * 10000 * fraud_count', 'total_transactions')} as rate_e4,
    {half_up('total_cents', 'total_transactions')} as avg_cents,
    cast(strftime(summary_hour, '%Y%m%d') as bigint) as date_key
  from (
    select date_trunc('hour', event_ts) as summary_hour, type as transaction_type,
      count(*) as total_transactions, cast(sum(cents) as bigint) as total_cents, max(cents) as max_cents,
      cast(sum(isFraud) as bigint) as fraud_count,
      cast(sum(case when isFraud = 1 then cents else 0 end) as bigint) as fraud_cents
    from tx group by 1, 2) t
  left join (select date_trunc('hour', alert_ts) as h, transaction_type as tt, count(*) as n
    from fa group by 1, 2) a on a.h = t.summary_hour and a.tt = t.transaction_type
)"""

_DATES = """dates as (
  select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as date) as full_date,
    year(d) as year, quarter(d) as quarter, month(d) as month, monthname(d) as month_name,
    weekofyear(d) as week_of_year, day(d) as day_of_month, isodow(d) as day_of_week,
    dayname(d) as day_name, cast(isodow(d) >= 6 as bigint) as is_weekend
  from (select unnest(generate_series(
    (select date_trunc('day', min(ts)) from events), (select date_trunc('day', max(ts)) from events),
    interval 1 day)) as d)
)"""

_RULES = """rules as (
  select * from (values
    ('R1_BLACKLIST', 'Blacklist Hit', 'CRITICAL'), ('R2_CREDIT_LIMIT', 'Credit Limit Breach', 'HIGH'),
    ('R3_GEO_VELOCITY', 'Geographic Velocity', 'HIGH'), ('R4_HIGH_VALUE_BURST', 'High-Value Burst', 'HIGH'),
    ('R5_BEHAVIORAL_ANOMALY', 'Behavioral Anomaly', 'MEDIUM'), ('R6_VELOCITY_BURST', 'Velocity Burst', 'MEDIUM')
  ) as v(rule_code, rule_name, severity)
)"""

_METRICS = """metrics as (
  select event_id as metric_id, date_trunc('hour', ts) as recorded_at,
    case event_type when 'click' then 'KAFKA' when 'purchase' then 'FLINK' when 'view' then 'HBASE'
      when 'error' then 'HDFS' else 'AIRFLOW' end as component,
    case user_id % 3 when 0 then 'lag' when 1 then 'latency' else 'throughput' end as metric_name,
    value as metric_value, case user_id % 3 when 0 then 'count' when 1 then 'ms' else 'pct' end as unit,
    case when value < 100 then 'OK' when value < 200 then 'WARNING' else 'CRITICAL' end as status,
    props as detail
  from events
)"""

_RUNS = """runs as (
  select event_id, ts as event_ts, 'run-' || strftime(ts, '%Y%m%d') as dag_run_id,
    'rules_guard' as task_id, 'job-' || user_id as job_id,
    case event_type when 'click' then 'RUNNING' when 'purchase' then 'FINISHED'
      when 'view' then 'FAILED' when 'error' then 'CANCELED' end as job_state
  from events
)"""

_FEED = f"""feed as (
  select strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') as "Time", event_ts,
    'TXN-' || upper(substr(md5(k), 1, 8)) as "Transaction_ID",
    '**** **** **** ' || right(repeat(case when regexp_replace(nameOrig, '[^0-9]', '', 'g') = '' then '0'
      else regexp_replace(nameOrig, '[^0-9]', '', 'g') end, 4), 4) as "Card_Mask",
    amount as "Amount", cents,
    list_extract(['Egypt', 'India', 'USA', 'Brazil', 'UK'], {hashed('nameOrig', 1)} % 5 + 1) as "Country",
    case when isFraud <> 0 then 'Blocked' else 'Approved' end as "Status",
    case when isFraud <> 0 then {hashed('k', 9)} % 16 + 85 else {hashed('k', 9)} % 20 + 1 end as score_e2,
    case when isFraud = 0 then 'None' when amount >= 2000 then 'High Amount'
      else list_extract(['Geographic Velocity', 'Card Testing', 'High Amount', 'Blacklisted Card',
        'Velocity (Time)'], {hashed('k', 17)} % 5 + 1) end as "Rule",
    isFraud as "isFraud"
  from (select *, nameOrig || ':' || ingestion_timestamp_ms || ':' || seq as k from tx)
)"""

_BODY = {
    "tx": _TX, "prof": _PROF, "bl": _BL, "feat": _feat(WINDOW_MS), "scored": _scored(GEO_MS),
    "fa": _FA, "ts": _TS, "dates": _DATES, "rules": _RULES, "metrics": _METRICS, "runs": _RUNS,
    "feed": _FEED,
}
_NEEDS = {
    "feat": ["tx"], "scored": ["feat", "prof", "bl"], "fa": ["scored"], "ts": ["tx", "fa"],
    "feed": ["tx"],
}


def sql(
    tables: str, body: str, window_ms: int | None = None, geo_ms: int | None = None, replayed: bool = False
) -> str:
    """``body`` with the named tables (and what they are built from) in front.

    ``replayed``: transactions carry the time stamps that a replay of CSV rows gives.
    """
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in tables.split():
        add(name)
    bodies = dict(_BODY)
    if replayed:
        bodies["tx"] = _TX_REPLAYED
    if window_ms is not None:
        bodies["feat"] = _feat(window_ms)
    if geo_ms is not None:
        bodies["scored"] = _scored(geo_ms)
    front = ",\n".join(bodies[name] for name in order)
    return f"with {front}\n{body}" if order else body
