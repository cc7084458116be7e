"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import case
from checks.sqltext import half_up, hashed, sql
from fraudloom import schemas
from fraudloom.functions import cells, dashboard, keys, parsing, times
from fraudloom.operators.alerts import as_json
from fraudloom.plans import kpi
from fraudloom.sources import backup


def _card():
    return F.col("nameOrig")


def _ts():
    return F.col("ingestion_timestamp_ms")


def _project(name, body, columns):
    """A projection of the transactions, keyed by seq; ``columns`` is called with a session at hand."""
    @case(name, sql("tx", f"select seq, {body} from tx"))
    def _(spark, sf):
        return fx.transactions(spark, sf).select("seq", *[c.alias(n) for n, c in columns().items()])


_project("f1_salt", "substr(md5(nameOrig), 1, 2) as salt", lambda: {"salt": keys.salt(_card())})
_project(
    "f2_row_keys",
    """substr(md5(nameOrig), 1, 2) || '_' || nameOrig as blacklist_key,
    substr(md5(nameOrig), 1, 2) || '_' || nameOrig || '_' || ym as profile_key""",
    lambda: {
        "blacklist_key": keys.blacklist_key(_card()),
        "profile_key": keys.profile_key(_card(), times.year_month(_ts())),
    },
)
_project(
    "f3_newest_first_key",
    """substr(md5(nameOrig), 1, 2) || '_' || nameOrig || '_' ||
    lpad(cast(9223372036854775807 - ingestion_timestamp_ms as varchar), 20, '0') as alert_key""",
    lambda: {"alert_key": keys.alert_key(_card(), _ts())},
)
_project(
    "f5_card_mask",
    "'**** **** **** ' || right(repeat(regexp_replace(nameOrig, '[^0-9]', '', 'g'), 4), 4) as card_mask",
    lambda: {"card_mask": dashboard.card_mask(_card())},
)
_project(
    "f6_country", f"""list_extract(['Egypt', 'India', 'USA', 'Brazil', 'UK'], {hashed('nameOrig', 1)} % 5 + 1) as country""",
    lambda: {"country": dashboard.country(_card())},
)
_project(
    "f7_transaction_id", "'TXN-' || upper(substr(md5(nameDest), 1, 8)) as transaction_id",
    lambda: {"transaction_id": dashboard.transaction_id(F.col("nameDest"))},
)
_project(
    "f8_iso_time", """strftime(case when seq % 10 = 0 then timestamp '2024-01-31 00:00:00' else event_ts end,
    '%Y-%m-%dT%H:%M:%S.%fZ') as iso_time""",
    lambda: {"iso_time": times.iso_micros(
        F.when(F.col("seq") % 10 != 0, _ts()).otherwise(0), F.lit(fx.AS_OF))},
)
_project(
    "f10_city_proxy", "substr(nameDest, 1, 3) as city",
    lambda: {"city": parsing.city_proxy(F.col("nameDest"))},
)
_project(
    "f16_hour_parts", """strftime(event_ts, '%Y') as year, strftime(event_ts, '%m') as month,
    strftime(event_ts, '%d') as day, strftime(event_ts, '%H') as hour""",
    lambda: times.hour_parts(times.event_time(_ts())),
)


@case("f4_key_ranges", sql("tx", """
select cast('0x' || substr(md5(nameOrig), 1, 2) as bigint) // 16 as key_range, count(*) as n from tx group by 1"""))
def _(spark, sf):
    return fx.transactions(spark, sf).groupBy(keys.key_range(keys.salt(_card())).alias("key_range")).agg(
        F.count(F.lit(1)).alias("n"))


@case("f9_parse_text", """
select event_id as seq, upper(trim(' ' || event_type || ' ')) as code,
  case when event_id % 5 = 0 then null else event_id end as whole,
  case when event_id % 7 = 0 then null else value end as number from events""")
def _(spark, sf):
    number = F.col("event_id")
    raw = fx.events(spark, sf).select(
        number.alias("seq"),
        F.concat(F.lit(" "), "event_type", F.lit("\t")).alias("code"),
        F.concat(F.lit(" "), number.cast("string"), F.when(number % 5 == 0, ".0").otherwise(" ")).alias("whole"),
        F.concat(F.col("value").cast("string"), F.when(number % 7 == 0, "d").otherwise(" ")).alias("number"),
    )
    return raw.select(
        "seq", parsing.clean_code(F.col("code")).alias("code"),
        parsing.to_int(F.col("whole")).alias("whole"), parsing.to_double(F.col("number")).alias("number"))


@case("f11_rule_lists", sql("fa", """
select alert_id, len(string_split(rules_triggered, ',')) as n_rules, rules_triggered as rules_text,
  cast(list_contains(string_split(rules_triggered, ','), 'R3_GEO_VELOCITY') as bigint) as has_r3 from fa"""))
def _(spark, sf):
    alerts = fx.mart(spark, sf)["fraud_alerts"]
    spaced = F.replace(F.col("rules_triggered"), F.lit(","), F.lit(" , "))
    rules = parsing.rule_list(F.concat(spaced, F.lit(","), F.col("rules_triggered")))
    return alerts.select(
        "alert_id", F.size(rules).alias("n_rules"), parsing.rule_text(rules).alias("rules_text"),
        (F.find_in_set(F.lit("R3_GEO_VELOCITY"), F.col("rules_triggered")) > 0).alias("has_r3"))


@case("f12_json_round_trip", sql("tx", "select seq, type, amount, nameOrig, ingestion_timestamp_ms from tx"))
def _(spark, sf):
    tx = fx.transactions(spark, sf)
    decoded = as_json(tx).select(parsing.from_json_text(F.col("value"), schemas.SEQUENCED).alias("tx"))
    return decoded.select("tx.seq", "tx.type", "tx.amount", "tx.nameOrig", "tx.ingestion_timestamp_ms")


@case("f13_dates", sql("tx", """
select seq, strftime(event_ts, '%Y-%m-%d') as day, strftime(event_ts, '%Y-%m-%d %H:00') as hour_label,
  yearweek(event_ts) as iso_week, strftime(event_ts - interval 7 day, '%Y-%m-%d') as week_ago from tx"""))
def _(spark, sf):
    at = times.event_time(_ts())
    return fx.transactions(spark, sf).select(
        "seq", F.to_date(at).alias("day"), times.hour_label(at).alias("hour_label"),
        times.iso_week(at).alias("iso_week"), F.date_sub(F.to_date(at), 7).alias("week_ago"))


@case("f14_round_nullif_case", sql("tx", f"""
select type, {half_up('10000 * cast(sum(isFraud) as bigint)', 'count(*)')} / 100.0 as fraud_pct,
  cast(sum(case when isFlaggedFraud = 1 then 1 else 0 end) as bigint) as flagged,
  count(nullif(isFraud, 0)) as labelled from tx group by type"""))
def _(spark, sf):
    return fx.transactions(spark, sf).groupBy("type").agg(
        kpi.share_pct(F.sum("isFraud"), F.count(F.lit(1))).alias("fraud_pct"),
        kpi.sum_if(F.col("isFlaggedFraud") == 1).alias("flagged"),
        F.count(F.nullif(F.col("isFraud"), F.lit(0))).alias("labelled"))


@case("f17_cell_map", sql("prof", """
select card_id, credit_limit, last_city, 4 as n_cells from prof"""))
def _(spark, sf):
    rows = backup.to_rows("user_profiles", fx.profiles(spark, sf), 0)
    columns = F.col("columns")
    return rows.select(
        cells.cell(columns, "account:card_id").alias("card_id"),
        cells.cell(columns, "account:credit_limit", "double").alias("credit_limit"),
        cells.cell(columns, "geo:last_city").alias("last_city"),
        F.size("columns").alias("n_cells"))


@case("f18_utf8_repair", """
select event_id as seq, cast(event_id % 9 = 0 as bigint) as repaired, event_type as kept from events""")
def _(spark, sf):
    number = F.col("event_id")
    raw = F.concat(
        F.encode("event_type", "UTF-8"),
        F.when(number % 9 == 0, F.lit(b"\xff")).otherwise(F.lit(b"")))
    fixed = cells.utf8(raw)
    return fx.events(spark, sf).select(
        number.alias("seq"), F.endswith(fixed, F.lit("�")).alias("repaired"),
        F.replace(fixed, F.lit("�"), F.lit("")).alias("kept"))


@case("f19_greatest_score", sql("scored", """
select score_e4 / 10000.0 as risk_score, count(*) as n from scored group by 1"""))
def _(spark, sf):
    return fx.scored(spark, sf).groupBy("risk_score").agg(F.count(F.lit(1)).alias("n"))
