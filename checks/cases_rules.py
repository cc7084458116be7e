"""Scoring: scans, lookups, windows, rules, alerts, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import case
from checks.sqltext import WINDOW_MS, sql, text
from fraudloom import config
from fraudloom.config import RuleConfig
from fraudloom.functions import keys
from fraudloom.functions.times import event_time, year_month
from fraudloom.operators import alerts, profiles, reference, rules, validate
from fraudloom.operators.trailing import trailing_features
from fraudloom.plans.scoring import fired
from fraudloom.session import work_dir
from fraudloom.streaming import features


def _ts():
    return F.col("ingestion_timestamp_ms")


# ---- windows --------------------------------------------------------------------
_FEATURES = "select nameOrig, seq, n_window, hv_window from feat"


@case("w1_trailing_counts", sql("feat", _FEATURES))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), fx.FIXTURE).select(
        "nameOrig", "seq", "n_window", "hv_window")


@case("w1_trailing_counts_5min", sql("feat", _FEATURES, window_ms=300_000))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), RuleConfig()).select(
        "nameOrig", "seq", "n_window", "hv_window")


@case("w1_trailing_counts_hot_cards", sql("feat", _FEATURES))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), fx.ALL_HOT).select(
        "nameOrig", "seq", "n_window", "hv_window")


@case("w2_previous_event", sql("feat", "select nameOrig, seq, prev_ts from feat"))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), fx.FIXTURE).select("nameOrig", "seq", "prev_ts")


@case("w2_previous_event_hot_cards", sql("feat", "select nameOrig, seq, prev_ts from feat"))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), fx.ALL_HOT).select("nameOrig", "seq", "prev_ts")


# ---- lookups --------------------------------------------------------------------
@case("j1_blacklist_lookup", sql("tx bl", """
select seq, nameOrig, b.is_active from tx left join bl b on b.card_id = nameOrig"""))
def _(spark, sf):
    return reference.blacklist_lookup(fx.transactions(spark, sf), fx.blacklist(spark, sf)).select(
        "seq", "nameOrig", "is_active")


@case("j2_profile_lookup", sql("tx prof", """
select seq, nameOrig, p.credit_limit, p.avg_amount, p.last_city
from tx left join prof p on p.card_id = nameOrig and p.year_month = ym"""))
def _(spark, sf):
    return reference.profile_lookup(fx.transactions(spark, sf), fx.profiles(spark, sf)).select(
        "seq", "nameOrig", "credit_limit", "avg_amount", "last_city")


_LOOKUPS = sql("tx prof bl", """
select seq, b.is_active, p.credit_limit, p.avg_amount, p.last_city, cast(null as bigint) as last_tx_ts
from tx left join bl b on b.card_id = nameOrig
left join prof p on p.card_id = nameOrig and p.year_month = ym""")


@case("s19_point_lookups", _LOOKUPS)
def _(spark, sf):
    out = reference.attach_reference(
        fx.transactions(spark, sf), fx.blacklist(spark, sf), fx.profiles(spark, sf))
    return out.select("seq", "is_active", *reference.PROFILE_FIELDS)


@case("s19_point_lookups_one_exchange", _LOOKUPS)
def _(spark, sf):
    side = reference.card_reference(fx.blacklist(spark, sf), fx.profiles(spark, sf))
    out = reference.month_fields(
        trailing_features(fx.transactions(spark, sf), fx.FIXTURE, reference=side))
    return out.select("seq", "is_active", *reference.PROFILE_FIELDS)


# ---- rules ----------------------------------------------------------------------
def _rule(name, code, flag):
    @case(name, sql("scored", f"select seq, nameOrig, amount, cast({flag} as bigint) as hit from scored"))
    def _(spark, sf):
        return fx.scored(spark, sf).select(
            "seq", "nameOrig", "amount", F.array_contains("rules_triggered", code).alias("hit"))


for _name, _code, _flag in (
    ("r1_blacklist", config.R1, "r1"), ("r2_credit_limit", config.R2, "r2"),
    ("r3_geo_velocity", config.R3, "r3"), ("r4_high_value_burst", config.R4, "r4"),
    ("r5_behavioral_anomaly", config.R5, "r5"), ("r6_velocity_burst", config.R6, "r6"),
):
    _rule(_name, _code, _flag)

_SCORES = """select seq, rules as rules_triggered, score_e4 / 10000.0 as risk_score,
  cast(score_e4 > 5000 as bigint) as flagged from scored"""


@case("r7_combined_score", sql("scored", _SCORES))
def _(spark, sf):
    return fx.scored(spark, sf).select("seq", "rules_triggered", "risk_score", "flagged")


@case("r7_combined_score_hot_cards", sql("scored", _SCORES))
def _(spark, sf):
    return fx.scored(spark, sf, fx.ALL_HOT).select("seq", "rules_triggered", "risk_score", "flagged")


@case("r7_combined_score_default_limits", sql("scored", _SCORES, window_ms=300_000, geo_ms=300_000))
def _(spark, sf):
    return fx.scored(spark, sf, RuleConfig()).select("seq", "rules_triggered", "risk_score", "flagged")


@case("r8_month_bucket", sql("tx", "select ym as year_month, count(*) as n from tx group by ym"))
def _(spark, sf):
    return fx.transactions(spark, sf).groupBy(year_month(_ts()).alias("year_month")).agg(
        F.count(F.lit(1)).alias("n"))


@case("r9_fail_open", sql("feat", """
select seq, concat_ws(',', case when hv_window >= 3 then 'R4_HIGH_VALUE_BURST' end,
  case when n_window >= 10 then 'R6_VELOCITY_BURST' end) as rules_triggered from feat"""))
def _(spark, sf):
    none = fx.blacklist(spark, sf).where("false")
    unknown = fx.profiles(spark, sf).where("false")
    featured = trailing_features(fx.transactions(spark, sf), fx.FIXTURE)
    out = rules.evaluate(reference.attach_reference(featured, none, unknown), fx.FIXTURE)
    return out.select("seq", "rules_triggered")


# ---- alerts ---------------------------------------------------------------------
_PAYLOAD = """select nameOrig as card_id, amount, type, rules as rules_triggered,
  score_e4 / 10000.0 as risk_score, isFraud as is_fraud_label,
  ingestion_timestamp_ms as alert_ts_ms from fired"""


@case("p2_alert_payload", sql("scored", _PAYLOAD))
def _(spark, sf):
    return alerts.alert_payload(fired(fx.scored(spark, sf)))


@case("p3_any_rule_fired", sql("scored", """
select type, count(*) as alerts from fired group by type"""))
def _(spark, sf):
    return fired(fx.scored(spark, sf)).groupBy("type").agg(F.count(F.lit(1)).alias("alerts"))


_ALERT_ROW = """
  substr(md5(nameOrig), 1, 2) || '_' || nameOrig || '_' ||
    lpad(cast(9223372036854775807 - ingestion_timestamp_ms as varchar), 20, '0') as row_key,
  rules, score_e4 / 10000.0 as risk_score, ingestion_timestamp_ms as ts, nameOrig, amount, type, nameDest"""


@case("s23_alert_upsert", sql("scored", f"""
select {_ALERT_ROW} from (
  select *, row_number() over (partition by nameOrig, ingestion_timestamp_ms order by seq desc) as rn
  from fired) where rn = 1"""))
def _(spark, sf):
    return alerts.upsert_alerts(fired(fx.scored(spark, sf)))


@case("s21_alert_history", sql("scored", f"""
select {_ALERT_ROW} from fired where nameOrig in (select card_id from bl where is_active = '1')"""))
def _(spark, sf):
    listed = fx.blacklist(spark, sf).where("is_active = '1'")
    return alerts.alert_history(alerts.upsert_alerts(fired(fx.scored(spark, sf))), listed)


@case("s24_alert_fact", sql("fa", f"""
select alert_id, {text('alert_ts')} as alert_ts, date_key, card_id, dest_id, transaction_type,
  cents / 100.0 as amount, rules_triggered, score_e4 / 10000.0 as risk_score, is_fraud_label,
  is_flagged_fraud, review_status, cast(null as varchar) as reviewed_by,
  cast(null as varchar) as reviewed_at, '2024-01-31 00:00:00.000000' as created_at from fa"""))
def _(spark, sf):
    return alerts.load_alert_fact(fx.reviewed(fired(fx.scored(spark, sf))), F.lit(fx.AS_OF))


@case("p17_load_defaults", sql("scored", """
select 'PENDING' as review_status, count(*) as n from fired"""))
def _(spark, sf):
    fact = alerts.load_alert_fact(fired(fx.scored(spark, sf)), F.lit(fx.AS_OF))
    return fact.groupBy("review_status").agg(F.count(F.lit(1)).alias("n"))


# ---- profiles -------------------------------------------------------------------
@case("s22_profile_write_back", sql("scored", """
, latest as (
  select nameOrig as card_id, ym as year_month, amount as last_amount, score_e4 / 10000.0 as score,
    case when score_e4 > 5000 then '1' else '0' end as flagged, ingestion_timestamp_ms as last_tx_ts
  from (select *, row_number() over (partition by nameOrig, ym order by ingestion_timestamp_ms desc, seq desc) as rn
    from scored) where rn = 1)
select card_id, year_month, p.credit_limit, p.last_city, l.last_amount, l.score, l.flagged, l.last_tx_ts
from prof p full join latest l using (card_id, year_month)"""))
def _(spark, sf):
    return profiles.merge_profiles(fx.profiles(spark, sf), fx.scored(spark, sf)).select(
        "card_id", "year_month", "credit_limit", "last_city", "last_amount", "score", "flagged", "last_tx_ts")


@case("w2_previous_event_across_months", sql("tx", """
, moved as (select seq, nameOrig, ingestion_timestamp_ms + 20 * 86400000 as ms from tx)
select seq, nameOrig, lag(ms) over (partition by nameOrig, strftime(make_timestamp(ms * 1000), '%Y%m') order by ms, seq) as prev_ts
from moved"""))
def _(spark, sf):
    """All events 20 days later: the previous event does not reach back over a month's end."""
    moved = fx.transactions(spark, sf).withColumn("ingestion_timestamp_ms", _ts() + 20 * 86_400_000)
    return trailing_features(moved, fx.FIXTURE).select("seq", "nameOrig", "prev_ts")


@case("x2_tails_across_months", sql("tx", f"""
, moved as (select *, ingestion_timestamp_ms + 20 * 86400000 as ms from tx),
later as (
  select m.seq, count(*) as n_window, max(case when p.seq <> m.seq and strftime(make_timestamp(p.ms * 1000), '%Y%m')
    = strftime(make_timestamp(m.ms * 1000), '%Y%m') then p.ms end) as near_prev
  from moved m join moved p on p.nameOrig = m.nameOrig and p.ms between m.ms - {WINDOW_MS} and m.ms
    and (p.ms < m.ms or p.seq <= m.seq) group by 1),
before as (
  select seq, lag(ms) over (partition by nameOrig, strftime(make_timestamp(ms * 1000), '%Y%m') order by ms, seq) as prev_ts
  from moved)
select m.seq, l.n_window, b.prev_ts from moved m join later l using (seq) join before b using (seq)
where m.ms >= 1704067200000 + 35 * cast(86400000 as bigint)"""))
def _(spark, sf):
    """All events 20 days later, the first 15 days handed to the rest as stored tails."""
    edge = F.lit(1_704_067_200_000 + 35 * 86_400_000)
    moved = fx.transactions(spark, sf).withColumn("ingestion_timestamp_ms", _ts() + 20 * 86_400_000)
    none = spark.createDataFrame([], features.STATE)
    path = work_dir(spark, "tails")
    features.next_state(moved.where(_ts() < edge), none, fx.FIXTURE).write.parquet(path)
    rest = moved.where(_ts() >= edge)
    return features.batch_features(rest, spark.read.parquet(path), fx.FIXTURE).select("seq", "n_window", "prev_ts")


@case("a12_rolling_stats", sql("feat", """
select nameOrig as card_id, ym as year_month, arg_max(n_window, seq) as tx_count_5m,
  arg_max(window_cents, seq) / 100.0 as amount_sum_5m,
  round((cast(sum(cents) as bigint) / 100.0) / count(*), 6) as avg_amount
from feat group by 1, 2"""))
def _(spark, sf):
    featured = trailing_features(fx.transactions(spark, sf), fx.FIXTURE, amounts=True)
    return profiles.rolling_stats(featured).withColumn("avg_amount", F.round("avg_amount", 6))


@case("a12_rolling_stats_hot_cards", sql("feat", """
select nameOrig, seq, n_window, window_cents / 100.0 as amount_window from feat"""))
def _(spark, sf):
    return trailing_features(fx.transactions(spark, sf), fx.ALL_HOT, amounts=True).select(
        "nameOrig", "seq", "n_window", "amount_window")


@case("s20_profile_months", sql("prof bl", """
select substr(md5(card_id), 1, 2) || '_' || card_id || '_' || year_month as row_key, card_id, credit_limit
from prof where card_id in (select card_id from bl)"""))
def _(spark, sf):
    return profiles.profile_months(fx.profiles(spark, sf), fx.blacklist(spark, sf)).select(
        "row_key", "card_id", "credit_limit")


def _versions(spark, sf):
    """Every event is a new version of its card's cells."""
    tx = fx.transactions(spark, sf)
    family = F.when(F.col("type") == "PAYMENT", "account").when(F.col("type") == "TRANSFER", "stats").when(
        F.col("type") == "CASH_OUT", "geo").otherwise("risk")
    return tx.select(
        keys.blacklist_key(F.col("nameOrig")).alias("row_key"), family.alias("family"),
        F.lower("type").alias("qualifier"), F.col("amount").cast("string").alias("value"),
        event_time(_ts()).alias("version_ts"), "seq")


_CELLS = """, cells as (
  select substr(md5(nameOrig), 1, 2) || '_' || nameOrig as row_key,
    case type when 'PAYMENT' then 'account' when 'TRANSFER' then 'stats' when 'CASH_OUT' then 'geo' else 'risk' end as family,
    lower(type) as qualifier, event_ts as version_ts, seq from tx)"""


@case("w3_latest_versions", sql("tx", f"""{_CELLS}
select row_key, qualifier, seq, rn as version_rank from (
  select *, row_number() over (partition by row_key, qualifier order by version_ts desc) as rn from cells)
where rn <= 3"""))
def _(spark, sf):
    return profiles.latest_versions(_versions(spark, sf), ["row_key", "qualifier"], "version_ts", 3).select(
        "row_key", "qualifier", "seq", "version_rank")


@case("w4_family_retention", sql("tx", f"""{_CELLS}
select row_key, family, qualifier, seq, rn as version_rank from (
  select *, row_number() over (partition by row_key, family, qualifier order by version_ts desc) as rn
  from cells where family in ('account') or (family = 'stats' and version_ts >= timestamp '2024-02-25' - interval 90 day)
    or (family = 'geo' and version_ts >= timestamp '2024-02-25' - interval 30 day)
    or (family = 'risk' and version_ts >= timestamp '2024-02-25' - interval 180 day))
where rn <= case family when 'account' then 1 when 'stats' then 3 when 'geo' then 10 else 20 end"""))
def _(spark, sf):
    from fraudloom.functions.times import instant
    return profiles.retained(_versions(spark, sf), "user_profiles", instant("2024-02-25 00:00:00")).select(
        "row_key", "family", "qualifier", "seq", "version_rank")


# ---- validation -----------------------------------------------------------------
def raw_rows(spark, sf):
    """Transactions as raw text, some of them padded and some damaged by event number."""
    tx, number = fx.transactions(spark, sf), F.col("seq")
    out = tx.drop("ingestion_timestamp_ms")
    for name in out.columns:
        if name != "seq":
            out = out.withColumn(name, F.col(name).cast("string"))
    return out.withColumns({
        "type": F.when(number % 11 == 0, F.concat(F.lit(" "), F.lower("type"), F.lit("\t")))
        .when(number % 13 == 0, "REFUND").otherwise(F.col("type")),
        "amount": F.when(number % 17 == 0, "x").when(number % 29 == 0, "1e17").when(number % 31 == 0, "nan")
        .when(number % 37 == 0, "-inf").otherwise(F.col("amount")),
        "step": F.when(number % 19 == 0, "1.0").when(number % 7 == 0, F.concat(F.lit(" "), "step", F.lit(" ")))
        .otherwise(F.col("step")),
        "nameDest": F.when(number % 23 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "nameDest")),
    })


_REASON = """, raw as (select *, case when seq % 13 = 0 and seq % 11 <> 0 then 'type' when seq % 19 = 0 then 'step'
  when seq % 17 = 0 or seq % 29 = 0 or seq % 31 = 0 or seq % 37 = 0 then 'amount' when seq % 23 = 0 then 'nameDest' end as reason from tx)"""


@case("s2_valid_rows", sql("tx", f"""{_REASON}
select seq, step, type, amount, nameOrig, nameDest, isFraud, 1700000000000 as ingestion_timestamp_ms
from raw where reason is null"""))
def _(spark, sf):
    checked = validate.check(raw_rows(spark, sf), F.lit(1_700_000_000_000))
    return validate.valid(checked).select(
        "seq", "step", "type", "amount", "nameOrig", "nameDest", "isFraud", "ingestion_timestamp_ms")


@case("s2_rejected_rows", sql("tx", f"{_REASON} select seq, reason from raw where reason is not null"))
def _(spark, sf):
    return validate.rejected(validate.check(raw_rows(spark, sf))).select("seq", "reason")


@case("s3_ingestion_stamp", sql("tx", "select count(*) as n, count(*) as stamped from tx"))
def _(spark, sf):
    recent = F.unix_millis(F.current_timestamp()) - F.col("parsed.ingestion_timestamp_ms")
    return validate.check(raw_rows(spark, sf)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(recent.between(0, 86_400_000)).alias("stamped"))


@case("a22_ingest_counts", sql("tx", f"""{_REASON}
select count(*) filter (reason is null) as sent, count(*) filter (reason is not null) as skipped from raw"""))
def _(spark, sf):
    return validate.ingest_counts(validate.check(raw_rows(spark, sf)))


@case("p15_domain_violations", sql("", """
select event_type, count(*) as n from events where event_type not in ('click', 'purchase', 'view') group by event_type"""))
def _(spark, sf):
    bad = validate.domain_violations(fx.events(spark, sf), "event_type", ("click", "purchase", "view"))
    return bad.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_BROKEN = """
select 'dim_transaction_type' as fact, 'type_name' as "column", 0 as rows, null as first_offender
union all select 'dim_rule', 'severity', 0, null
union all select 'fraud_alerts', 'review_status', count(*) filter (alert_id % 5 = 0),
  case when count(*) filter (alert_id % 5 = 0) > 0 then 'LOST' end from fa
union all select 'pipeline_health_metrics', 'status', (select count(*) from events where event_id % 7 = 0), null
union all select 'pipeline_events', 'severity', (
    select count(*) from events where event_type not in ('click', 'purchase') and event_id % 2 = 0),
  'critical'"""


@case("p15_declared_domains", sql("fa", _BROKEN))
def _(spark, sf):
    """All five declared domains in one pass over each table; some stored codes are damaged first."""
    tables = fx.mart(spark, sf)
    tables = {name: tables[name] for name, _ in config.DOMAINS}
    tables["fraud_alerts"] = tables["fraud_alerts"].withColumn(
        "review_status", F.when(F.col("alert_id") % 5 == 0, "LOST").otherwise(F.col("review_status")))
    metrics = tables["pipeline_health_metrics"]
    tables["pipeline_health_metrics"] = metrics.withColumn("status", F.when(F.col("metric_id") % 7 != 0, F.col("status")))
    tables["pipeline_events"] = tables["pipeline_events"].withColumn(
        "severity", F.when(F.col("event_id") % 2 == 0, F.lower("severity")).otherwise(F.col("severity")))
    return validate.violations(tables, config.DOMAINS)


@case("p16_system_flag", sql("tx", """
select seq, isFlaggedFraud, cast(type = 'TRANSFER' and amount > 15000 as bigint) as expected_flag
from tx where isFlaggedFraud <> cast(type = 'TRANSFER' and amount > 15000 as bigint)"""))
def _(spark, sf):
    return validate.flag_mismatches(fx.transactions(spark, sf), 15_000.0).select(
        "seq", "isFlaggedFraud", "expected_flag")
