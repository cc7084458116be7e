"""Dashboard feed, its measures, and pipeline health."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import case
from checks.sqltext import AS_OF, half_up, sql, text
from fraudloom import config
from fraudloom.functions.times import event_time
from fraudloom.plans import dashboard, health

_FEED = '"Time", "Transaction_ID", "Card_Mask", "Amount", "Country", "Status", score_e2 / 100.0 as "Score", "Rule"'


def _feed(spark, sf):
    return fx.mart(spark, sf)["feed"]


@case("p9_enrichment", sql("feed", f'select {_FEED}, "isFraud" from feed'))
def _(spark, sf):
    return dashboard.enrich(fx.transactions(spark, sf))


@case("p10_status", sql("feed", 'select "Status", count(*) as n from feed group by 1'))
def _(spark, sf):
    return dashboard.enrich(fx.transactions(spark, sf)).groupBy("Status").agg(F.count(F.lit(1)).alias("n"))


@case("p11_score_and_rule", sql("feed", """
select "Rule", score_e2 / 100.0 as "Score", count(*) as n from feed group by 1, 2"""))
def _(spark, sf):
    return dashboard.enrich(fx.transactions(spark, sf)).groupBy("Rule", "Score").agg(
        F.count(F.lit(1)).alias("n"))


_BAND = """case when score_e2 >= 95 then 'Critical' when score_e2 >= 85 then 'High'
  when score_e2 >= 50 then 'Medium' else 'Low' end"""


@case("p12_severity_band", sql("feed", f'select "Transaction_ID", {_BAND} as severity from feed'))
def _(spark, sf):
    from fraudloom.functions.dashboard import severity
    return _feed(spark, sf).select("Transaction_ID", severity(F.col("Score")).alias("severity"))


_HOUR = f"event_ts > {AS_OF} - interval 1 hour and event_ts <= {AS_OF}"


@case("p13_last_hour", sql("feed", f'select "Time", "Transaction_ID" from feed where {_HOUR}'))
def _(spark, sf):
    return dashboard.last_hour(_feed(spark, sf), fx.AS_OF).select("Time", "Transaction_ID")


@case("p14_named_rules", sql("feed", """select "Transaction_ID", "Rule" from feed where "Rule" <> 'None'"""))
def _(spark, sf):
    return dashboard.named_rules(_feed(spark, sf)).select("Transaction_ID", "Rule")


@case("o3_latest_transactions", sql("feed", f"""
select {_FEED} from feed order by "Time" desc, "Transaction_ID" limit 50"""))
def _(spark, sf):
    return dashboard.latest_transactions(_feed(spark, sf))


@case("a13_fraud_rate", sql("feed", """
select count(*) as total_transactions, cast(sum("isFraud") as bigint) as fraud_transactions,
  cast(sum("isFraud") as double) / count(*) as fraud_rate from feed"""))
def _(spark, sf):
    return dashboard.card_measures(_feed(spark, sf)).select(
        "total_transactions", "fraud_transactions", "fraud_rate")


@case("a14_score_and_loss", sql("feed", f"""
select {half_up('10000 * cast(sum(score_e2) as bigint)', 'count(*)')} / 1000000.0 as average_score,
  cast(sum(cents) filter ("Status" = 'Blocked') as bigint) / 100.0 as loss_prevented from feed"""))
def _(spark, sf):
    return dashboard.card_measures(_feed(spark, sf)).select("average_score", "loss_prevented")


@case("a15_fraud_gauge", sql("feed", """
select cast(sum("isFraud") as double) / count(*) as fraud_rate, cast(0.007 as double) as target,
  cast(0 as double) as scale_min, cast(0.01 as double) as scale_max,
  cast(cast(sum("isFraud") as double) / count(*) > 0.007 as bigint) as above_target from feed"""))
def _(spark, sf):
    return dashboard.fraud_gauge(_feed(spark, sf))


@case("a16_throughput", sql("feed", """
select count(*) / cast(date_diff('second', min(event_ts), max(event_ts)) as double) as tps from feed"""))
def _(spark, sf):
    return dashboard.throughput(_feed(spark, sf))


_MINUTES = f"""select {text("date_trunc('minute', event_ts)")} as bucket, count(*) as total_transactions,
  cast(sum("isFraud") as bigint) as fraud_transactions from feed group by 1"""


@case("a16_throughput_per_minute", sql("feed", _MINUTES))
def _(spark, sf):
    return dashboard.throughput_buckets(_feed(spark, sf))


def _versus() -> str:
    measures = {
        "total_transactions": "cast(count(*) filter ({c}) as double)",
        "fraud_transactions": "cast(count(*) filter ({c} and \"isFraud\" = 1) as double)",
        "fraud_rate": "count(*) filter ({c} and \"isFraud\" = 1) / cast(nullif(count(*) filter ({c}), 0) as double)",
        "average_score": "(2 * 10000 * cast(sum(score_e2) filter ({c}) as bigint) + count(*) filter ({c}))"
                         " // (2 * nullif(count(*) filter ({c}), 0)) / 1000000.0",
        "loss_prevented": "cast(sum(cents) filter ({c} and \"Status\" = 'Blocked') as bigint) / 100.0",
    }
    now = f"(event_ts > {AS_OF} - interval 1 hour and event_ts <= {AS_OF})"
    before = f"(event_ts > {AS_OF} - interval 2 hour and event_ts <= {AS_OF} - interval 1 hour)"
    parts = [f"{m.format(c=now)} as {n}_now, {m.format(c=before)} as {n}_before" for n, m in measures.items()]
    deltas = [
        f"{n}_now, {n}_before, 100 * ({n}_now - {n}_before) / nullif({n}_before, 0) as {n}_delta_pct"
        for n in measures
    ]
    return f"select {', '.join(deltas)} from (select {', '.join(parts)} from feed)"


@case("a17_versus_last_hour", sql("feed", _versus()))
def _(spark, sf):
    return dashboard.versus_last_hour(_feed(spark, sf), fx.AS_OF)


@case("a18_fraud_by_country", sql("feed", """
select "Country", cast(sum("isFraud") as bigint) as fraud_transactions from feed group by 1"""))
def _(spark, sf):
    return dashboard.fraud_by_country(_feed(spark, sf))


@case("a19_top_rules", sql("feed", """
select "Rule", cast(sum("isFraud") as bigint) as fraud_transactions,
  cast(sum("isFraud") as double) / (select sum("isFraud") from feed) as rule_share
from feed where "Rule" <> 'None' group by 1"""))
def _(spark, sf):
    return dashboard.top_rules(_feed(spark, sf))


@case("a20_severity_counts", sql("feed", f"select {_BAND} as severity, count(*) as n from feed group by 1"))
def _(spark, sf):
    return dashboard.severity_counts(_feed(spark, sf))


_PAYLOADS = """, numbered as (
  select epoch(event_ts)::bigint // 86400 as flush_interval, "Transaction_ID",
    row_number() over (partition by epoch(event_ts)::bigint // 86400
      order by "Time", "Transaction_ID", "Card_Mask", "Amount") as r from feed)
select flush_interval, count(*) as n_rows, string_agg("Transaction_ID", ',' order by r) as ids
from numbered group by flush_interval, (r - 1) // 20"""


def _sent(payloads):
    """What each payload holds."""
    row = F.from_json("payload_json", "rows array<struct<Transaction_ID string>>").getField("rows")
    return payloads.select("flush_interval", "n_rows", F.concat_ws(",", row.getField("Transaction_ID")).alias("ids"))


@case("s13_push_payloads", sql("feed", _PAYLOADS))
def _(spark, sf):
    return _sent(dashboard.push_payloads(_feed(spark, sf), flush_seconds=86_400))


@case("s13_push_payloads_split", sql("feed", _PAYLOADS))
def _(spark, sf):
    """The grain of the numbering does not show in the payloads."""
    return _sent(dashboard.push_payloads(_feed(spark, sf), flush_seconds=86_400, id_digits=0))


# ---- health ---------------------------------------------------------------------
def _offsets(spark, sf):
    """Offsets of one topic per event type; every fourth partition has no commit."""
    number = F.col("event_id")
    return fx.events(spark, sf).groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition")
    ).agg(
        F.min(number).alias("low"), (F.max(number) + 1).alias("high"),
        F.when(F.min(F.col("user_id") % 4) == 3, F.lit(-1)).otherwise(
            F.max(F.when(F.col("value") < 50, number + 3))).alias("committed"),
        F.when(F.max("value") > 300, F.lit(-1)).otherwise(F.min(F.col("user_id") % 4)).alias("leader"))


_OFFSETS = """offsets as (
  select event_type as topic, user_id % 4 as partition, min(event_id) as low, max(event_id) + 1 as high,
    case when user_id % 4 = 3 then -1 else max(event_id + 3) filter (value < 50) end as committed,
    case when max(value) > 300 then -1 else user_id % 4 end as leader
  from events group by 1, 2)"""


@case("a21_consumer_lag", f"""with {_OFFSETS}
select topic, cast(sum(greatest(0, high - case when committed >= 0 then committed else low end)) as bigint) as total_lag,
  cast(sum(greatest(0, high - case when committed >= 0 then committed else low end)) > 10000 as bigint) as over_threshold
from offsets group by topic""")
def _(spark, sf):
    return health.consumer_lag(_offsets(spark, sf), 10_000)


@case("a23_topic_health", f"""with {_OFFSETS}, expected as (
  select distinct event_type as topic from events union select distinct event_type || '-missing' from events)
select topic, cast(reason = 'OK' as bigint) as healthy, reason, partition_count from (
  select e.topic, count(o.partition) as partition_count,
    case when count(o.partition) = 0 then 'Topic ''' || e.topic || ''' does not exist'
      when count(*) filter (leader = -1) > 0 then 'Partitions without leader: [' ||
        string_agg(cast(o.partition as varchar), ', ' order by o.partition) filter (leader = -1) || ']'
      else 'OK' end as reason
  from expected e left join offsets o on o.topic = e.topic group by e.topic)""")
def _(spark, sf):
    offsets = _offsets(spark, sf)
    known = fx.events(spark, sf).select(F.col("event_type").alias("topic")).distinct()
    missing = known.select(F.concat("topic", F.lit("-missing")).alias("topic"))
    return health.topic_health(known.unionByName(missing), offsets)


def _probes(spark, sf):
    """One probe per event; those with a low value got no answer."""
    metrics = fx.health_metrics(spark, sf)
    tx = fx.transactions(spark, sf).select("seq", event_time(F.col("ingestion_timestamp_ms")).alias("probe_ts"))
    return metrics.join(tx, metrics.metric_id == tx.seq).select(
        "probe_ts", F.initcap("component").alias("component"),
        F.when(F.col("metric_value") >= 5, F.col("metric_value")).alias("latency_ms"))


_PROBES = """, probes as (
  select strftime(tx.event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') as "Time",
    upper(component[1]) || lower(component[2:]) as "System_Component",
    case when metric_value >= 5 then 'Healthy' else 'Down' end as "Component_Status",
    case when metric_value >= 5 then (cast(round(metric_value * 100) as bigint) + 5) // 10 / 10.0 else -1.0 end as "Latency_ms"
  from metrics join tx on tx.seq = metric_id)"""


@case("x12_health_rows", sql("tx metrics", f"{_PROBES} select * from probes"))
def _(spark, sf):
    return health.health_rows(_probes(spark, sf))


@case("x12_latest_status", sql("tx metrics", f"""{_PROBES}
select "System_Component", max("Time") as "Time" from probes group by 1"""))
def _(spark, sf):
    return health.latest_status(health.health_rows(_probes(spark, sf))).select("System_Component", "Time")


@case("x13_safe_mode_decision", sql("scored runs", """
select seq, case when coalesce(job_state, '') not in ('RUNNING', 'FINISHED') then 'MANUAL_REVIEW'
  when score_e4 > 5000 then 'BLOCK' else 'APPROVE' end as decision
from scored join runs on runs.event_id = scored.seq"""))
def _(spark, sf):
    runs = fx.job_runs(spark, sf).select(F.col("event_id").alias("seq"), "job_state")
    scored = fx.scored(spark, sf).join(runs, "seq")
    return health.apply_safe_mode(scored, health.safe_mode(F.col("job_state"))).select("seq", "decision")


@case("x13_safe_mode_events", sql("runs", """
select event_id, cast(strftime(event_ts, '%Y%m%d') as bigint) as date_key, 'SAFE_MODE' as event_type,
  'Job ' || job_id || ' status=' || coalesce(job_state, 'UNKNOWN') as message
from runs where coalesce(job_state, '') not in ('RUNNING', 'FINISHED')"""))
def _(spark, sf):
    return health.safe_mode_events(fx.job_runs(spark, sf)).select("event_id", "date_key", "event_type", "message")
