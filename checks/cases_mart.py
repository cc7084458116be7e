"""Dimensions, facts, views and the twelve KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import case
from checks.sqltext import AS_OF, NOON, half_up, sql, text
from fraudloom.functions.times import instant
from fraudloom.plans import kpi, mart

_NOON = instant("2024-01-30 12:00:00")


def _tables(spark, sf, *names):
    tables = fx.mart(spark, sf)
    return [tables[name] for name in names]


# ---- dimensions -----------------------------------------------------------------
@case("f15_dim_date", sql("dates", """
select date_key, strftime(full_date, '%Y-%m-%d') as full_date, year, quarter, month, month_name, week_of_year,
  day_of_month, day_of_week, day_name, is_weekend from dates"""))
def _(spark, sf):
    return _tables(spark, sf, "dim_date")[0]


@case("s25_seed_insert_ignore", sql("tx", """
select type as type_name, case type when 'PAYMENT' then 'Point-of-sale or online payment'
  when 'TRANSFER' then 'Account-to-account transfer' when 'CASH_OUT' then 'ATM or cash withdrawal'
  when 'DEBIT' then 'seen' else 'seen' end as description
from (select distinct type from tx)"""))
def _(spark, sf):
    """Types seen in the data are seeds already, two of them; the rest is inserted."""
    seen = fx.transactions(spark, sf).where("type in ('DEBIT', 'CASH_IN')").select("type").distinct()
    existing = seen.select(F.col("type").alias("type_name"), F.lit("seen").alias("description"))
    seeds = _tables(spark, sf, "dim_transaction_type")[0].drop("type_id")
    return mart.insert_ignore(existing, seeds, "type_name")


@case("j8_insert_ignore", sql("tx bl", """
select card_id from (select distinct nameOrig as card_id from tx where isFraud = 1
union select card_id from bl)"""))
def _(spark, sf):
    listed = fx.blacklist(spark, sf).select("card_id")
    fraud = fx.transactions(spark, sf).where("isFraud = 1").select(F.col("nameOrig").alias("card_id")).distinct()
    return mart.insert_ignore(listed, fraud, "card_id")


# ---- facts and views ------------------------------------------------------------
_SUMMARY = """select epoch(summary_hour)::bigint // 3600 * 10 + list_position(
    ['PAYMENT', 'TRANSFER', 'CASH_OUT', 'DEBIT', 'CASH_IN'], transaction_type) as summary_id,
  strftime(summary_hour, '%Y-%m-%d %H:%M:%S.%f') as summary_hour, date_key, transaction_type,
  total_transactions, total_cents / 100.0 as total_amount, avg_cents / 100.0 as avg_amount,
  max_cents / 100.0 as max_amount, fraud_count, fraud_cents / 100.0 as fraud_amount,
  rate_e4 / 10000.0 as fraud_rate_pct, {alerts} as alerts_generated from ts"""


@case("a11_hourly_summary", sql("ts", _SUMMARY.format(alerts="alerts_generated")))
def _(spark, sf):
    alerts = _tables(spark, sf, "fraud_alerts")[0]
    return mart.hourly_summary(fx.transactions(spark, sf), alerts).drop("created_at")


@case("j3_alert_detail_view", sql("fa dates", f"""
select alert_id, {text('alert_ts')} as alert_ts, strftime(full_date, '%Y-%m-%d') as full_date, year, month,
  month_name, day_of_week, day_name, is_weekend, card_id, dest_id, transaction_type, cents / 100.0 as amount,
  rules_triggered, score_e4 / 10000.0 as risk_score, is_fraud_label, is_flagged_fraud, review_status
from fa join dates using (date_key)"""))
def _(spark, sf):
    mart.register_views(fx.mart(spark, sf))
    return spark.sql("select * from vw_fraud_alert_detail")


@case("p8_hourly_rate_view", sql("ts", f"""
select {text('summary_hour')} as summary_hour, transaction_type, total_transactions, fraud_count,
  rate_e4 / 10000.0 as fraud_rate_pct, total_cents / 100.0 as total_amount, fraud_cents / 100.0 as fraud_amount,
  alerts_generated from ts"""))
def _(spark, sf):
    return mart.hourly_fraud_rate(_tables(spark, sf, "transaction_summaries")[0])


_LATEST = f"""select component, metric_name, metric_value, unit, status, {text('recorded_at')} as recorded_at, detail
from metrics m where recorded_at = (select max(recorded_at) from metrics m2
  where m2.component = m.component and m2.metric_name = m.metric_name)"""


@case("j6_latest_health_view", sql("metrics", _LATEST))
def _(spark, sf):
    return mart.latest_health(_tables(spark, sf, "pipeline_health_metrics")[0])


@case("w5_latest_row_per_group", sql("metrics", f"""
select component, {text('max(recorded_at)')} as recorded_at, count(*) as metrics_seen from metrics group by component"""))
def _(spark, sf):
    metrics = _tables(spark, sf, "pipeline_health_metrics")[0]
    newest = mart.newest_in_group(metrics, ["component"], ["recorded_at", "metric_id"]).select("component", "recorded_at")
    return newest.join(metrics.groupBy("component").agg(F.count(F.lit(1)).alias("metrics_seen")), "component")


@case("j9_date_orphans", sql("fa", f"""
select alert_id, date_key from fa where date_key > 20240115"""))
def _(spark, sf):
    alerts, dates = _tables(spark, sf, "fraud_alerts", "dim_date")
    return mart.date_orphans(alerts, dates.where("date_key <= 20240115")).select("alert_id", "date_key")


@case("j9_date_orphans_all_facts", sql("fa ts metrics runs", """, keys as (
  select 'fraud_alerts' as fact, date_key from fa
  union all select 'transaction_summaries', date_key from ts
  union all select 'pipeline_health_metrics', cast(strftime(recorded_at, '%Y%m%d') as bigint) from metrics
  union all select 'pipeline_events', cast(strftime(event_ts, '%Y%m%d') as bigint) from runs
    where coalesce(job_state, '') not in ('RUNNING', 'FINISHED')
) select fact, date_key, count(*) as orphans from keys where date_key > 20240115 group by 1, 2"""))
def _(spark, sf):
    """Orphans of every fact against a calendar that ends in the middle of the month."""
    names = ("fraud_alerts", "transaction_summaries", "pipeline_health_metrics", "pipeline_events")
    *facts, dates = _tables(spark, sf, *names, "dim_date")
    known = dates.where("date_key <= 20240115")
    found = [mart.date_orphans(f, known).select(F.lit(n).alias("fact"), "date_key") for n, f in zip(names, facts)]
    alerts, hours, metrics, jobs = found
    return alerts.unionAll(hours).unionAll(metrics).unionAll(jobs).groupBy("fact", "date_key").agg(
        F.count(F.lit(1)).alias("orphans"))


# ---- filters --------------------------------------------------------------------
@case("p4_same_day", sql("fa", f"""
select alert_id, card_id from fa where cast(alert_ts as date) = cast({NOON} as date)"""))
def _(spark, sf):
    return mart.on_day(_tables(spark, sf, "fraud_alerts")[0], "alert_ts", _NOON).select("alert_id", "card_id")


@case("p5_relative_windows", sql("fa ts", f"""
select '7 DAYS' as period, count(*) as n from fa where alert_ts >= {NOON} - interval 7 day
union all select '84 DAYS', count(*) from fa where alert_ts >= {NOON} - interval 84 day
union all select '24 HOURS', count(*) from ts where summary_hour >= {NOON} - interval 24 hour
union all select '30 DAYS', count(*) from ts where summary_hour >= {NOON} - interval 30 day"""))
def _(spark, sf):
    alerts, summaries = _tables(spark, sf, "fraud_alerts", "transaction_summaries")
    parts = [
        mart.since(df, column, _NOON, period).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(period).alias("period"), "n")
        for df, column, period in (
            (alerts, "alert_ts", "7 DAYS"), (alerts, "alert_ts", "84 DAYS"),
            (summaries, "summary_hour", "24 HOURS"), (summaries, "summary_hour", "30 DAYS"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@case("p6_open_reviews", sql("fa", """
select review_status, count(*) as n from fa where review_status in ('PENDING', 'UNDER_REVIEW') group by 1"""))
def _(spark, sf):
    alerts = _tables(spark, sf, "fraud_alerts")[0]
    return kpi.open_reviews(alerts).groupBy("review_status").agg(
        F.count(F.lit(1)).alias("n"))


@case("p7_high_risk_pending", sql("fa", """
select alert_id from fa where score_e4 >= 7000 and review_status = 'PENDING'"""))
def _(spark, sf):
    alerts = _tables(spark, sf, "fraud_alerts")[0]
    return kpi.high_risk_pending(alerts).select("alert_id")


# ---- KPIs -----------------------------------------------------------------------
@case("a1_alerts_today", sql("fa", f"""
select count(*) as alerts_today from fa where cast(alert_ts as date) = cast({NOON} as date)"""))
def _(spark, sf):
    return kpi.alerts_today(_tables(spark, sf, "fraud_alerts")[0], _NOON)


@case("a2_precision", sql("fa", f"""
select count(*) as total_alerts, cast(sum(is_fraud_label) as bigint) as true_positives,
  cast(sum(1 - is_fraud_label) as bigint) as false_positives,
  {half_up('10000 * cast(sum(is_fraud_label) as bigint)', 'count(*)')} / 100.0 as precision_pct from fa"""))
def _(spark, sf):
    return kpi.detection_precision(_tables(spark, sf, "fraud_alerts")[0])


_AVG_SCORE = half_up("cast(sum(score_e4) as bigint)", "count(*)")


@case("a3_risk_by_type", sql("fa", f"""
select transaction_type, {_AVG_SCORE} / 10000.0 as avg_risk_score, count(*) as alert_count,
  cast(sum(cents) as bigint) / 100.0 as total_flagged_amount from fa group by transaction_type"""))
def _(spark, sf):
    return kpi.risk_by_type(_tables(spark, sf, "fraud_alerts")[0])


_TOP = f"""select card_id, count(*) as total_alerts, {_AVG_SCORE} / 10000.0 as avg_risk_score,
  cast(sum(cents) as bigint) / 100.0 as total_flagged_amount, {text('max(alert_ts)')} as last_seen
from fa where alert_ts >= {AS_OF} - interval 7 day
group by card_id order by total_alerts desc, card_id limit 10"""


@case("a4_top_cards", sql("fa", _TOP))
def _(spark, sf):
    return kpi.top_cards(_tables(spark, sf, "fraud_alerts")[0], fx.AS_OF)


@case("o1_top_ten", sql("fa", """
select card_id, count(*) as total_alerts from fa group by card_id order by total_alerts desc, card_id limit 10"""))
def _(spark, sf):
    alerts = _tables(spark, sf, "fraud_alerts")[0]
    return kpi.busiest_cards(alerts).select("card_id", "total_alerts")


@case("a5_hourly_volume", sql("ts", f"""
select strftime(summary_hour, '%Y-%m-%d %H:00') as hour_label,
  cast(sum(total_transactions) as bigint) as total_txn, cast(sum(fraud_count) as bigint) as fraud_txn,
  {half_up('cast(sum(rate_e4) as bigint)', 'count(*)')} / 10000.0 as avg_fraud_rate_pct,
  cast(sum(total_cents) as bigint) / 100.0 as total_volume, cast(sum(fraud_cents) as bigint) / 100.0 as fraud_volume
from ts where summary_hour >= {AS_OF} - interval 24 hour group by 1"""))
def _(spark, sf):
    return kpi.hourly_volume(_tables(spark, sf, "transaction_summaries")[0], fx.AS_OF)


_RULES_FIRED = """, fired_rules as (select alert_id, unnest(string_split(rules_triggered, ',')) as rule_code from fa)"""


@case("a6_rule_frequency", sql("fa rules", f"""{_RULES_FIRED}
select r.rule_code, rule_name, severity, count(alert_id) as trigger_count,
  {half_up('10000 * count(alert_id)', '(select count(*) from fa)')} / 100.0 as pct_of_all_alerts
from rules r left join fired_rules f on f.rule_code = r.rule_code group by 1, 2, 3"""))
def _(spark, sf):
    return kpi.rule_frequency(*_tables(spark, sf, "fraud_alerts", "dim_rule"))


@case("j4_rule_membership", sql("fa rules", f"""{_RULES_FIRED}
select r.rule_code, alert_id from rules r left join fired_rules f on f.rule_code = r.rule_code"""))
def _(spark, sf):
    alerts, rules = _tables(spark, sf, "fraud_alerts", "dim_rule")
    return rules.select("rule_code").join(kpi.rule_members(alerts, "alert_id"), "rule_code", "left")


@case("j7_share_of_all", sql("fa", f"""
select transaction_type, {half_up('10000 * count(*)', '(select count(*) from fa)')} / 100.0 as pct_of_all_alerts
from fa group by transaction_type"""))
def _(spark, sf):
    return kpi.share_of_all(_tables(spark, sf, "fraud_alerts")[0], "transaction_type")


@case("a7_daily_summary", sql("ts dates", f"""
select strftime(full_date, '%Y-%m-%d') as full_date, day_name,
  coalesce(cast(sum(total_transactions) as bigint), 0) as total_transactions,
  coalesce(cast(sum(fraud_count) as bigint), 0) as fraud_count,
  coalesce(cast(sum(fraud_cents) as bigint), 0) / 100.0 as fraud_amount,
  coalesce(cast(sum(alerts_generated) as bigint), 0) as alerts_generated,
  coalesce({half_up('10000 * cast(sum(rate_e4) as bigint)', 'nullif(count(rate_e4), 0)')}, 0) / 100000000.0 as avg_fraud_rate_pct
from dates left join ts using (date_key)
where full_date >= cast({AS_OF} as date) - interval 30 day group by 1, 2"""))
def _(spark, sf):
    return kpi.daily_summary(*_tables(spark, sf, "transaction_summaries", "dim_date"), fx.AS_OF)


@case("j5_date_spine", sql("ts dates", """
select strftime(full_date, '%Y-%m-%d') as full_date, count(summary_hour) as summaries
from dates left join ts using (date_key) group by 1"""))
def _(spark, sf):
    dates, summaries = _tables(spark, sf, "dim_date", "transaction_summaries")
    per_day = summaries.groupBy("date_key").agg(F.count("summary_hour").alias("summaries"))
    return kpi.on_days(dates.select("date_key", "full_date"), per_day)


@case("a8_health_summary", sql("metrics", _LATEST))
def _(spark, sf):
    return kpi.health_summary(_tables(spark, sf, "pipeline_health_metrics")[0])


@case("o2_review_queue", sql("fa", f"""
select alert_id, {text('alert_ts')} as alert_ts, card_id, transaction_type, cents / 100.0 as amount,
  score_e4 / 10000.0 as risk_score, rules_triggered, is_fraud_label, review_status
from fa where review_status in ('PENDING', 'UNDER_REVIEW')
order by score_e4 desc, fa.alert_ts desc, alert_id limit 200"""))
def _(spark, sf):
    return kpi.review_queue(_tables(spark, sf, "fraud_alerts")[0])


@case("a9_weekly_outcomes", sql("fa", f"""
select yearweek(alert_ts) as iso_week, strftime(min(cast(alert_ts as date)), '%Y-%m-%d') as week_start,
  count(*) filter (review_status = 'CONFIRMED_FRAUD') as confirmed_fraud,
  count(*) filter (review_status = 'FALSE_POSITIVE') as false_positives,
  count(*) filter (review_status = 'PENDING') as pending, count(*) as total_alerts
from fa where alert_ts >= {AS_OF} - interval 84 day group by 1"""))
def _(spark, sf):
    return kpi.weekly_outcomes(_tables(spark, sf, "fraud_alerts")[0], fx.AS_OF)


@case("a10_exposure", sql("fa", f"""
select count(*) as high_risk_pending_alerts, cast(sum(cents) as bigint) / 100.0 as total_exposure,
  max(score_e4) / 10000.0 as max_risk_score,
  {half_up('10000 * cast(sum(cents) as bigint)', 'count(*)')} / 1000000.0 as avg_high_risk_amount
from fa where score_e4 >= 7000 and review_status = 'PENDING'"""))
def _(spark, sf):
    return kpi.exposure(_tables(spark, sf, "fraud_alerts")[0])


@case("o5_safe_mode_timeline", sql("runs", f"""
select {text('event_ts')} as event_ts, 'SAFE_MODE' as event_type, 'FLINK' as component, 'CRITICAL' as severity,
  dag_run_id, 'Job ' || job_id || ' status=' || coalesce(job_state, 'UNKNOWN') as message
from runs where coalesce(job_state, '') not in ('RUNNING', 'FINISHED')
  and event_ts >= timestamp '2024-02-10' - interval 30 day"""))
def _(spark, sf):
    return kpi.safe_mode_timeline(_tables(spark, sf, "pipeline_events")[0], instant("2024-02-10 00:00:00"))


@case("o4_presentation_sorts", sql("ts", f"""
select row_number() over (order by rate_e4 desc, summary_hour desc, transaction_type) as place,
  {text('summary_hour')} as summary_hour, transaction_type, rate_e4 / 10000.0 as fraud_rate_pct
from ts qualify place <= 100"""))
def _(spark, sf):
    """A ranked report: the hundred worst hours with their places."""
    return kpi.worst_hours(_tables(spark, sf, "transaction_summaries")[0])
