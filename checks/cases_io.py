"""Sources, sinks, archive, backup, streams.

Streams run over topic folders that Spark fills from the whole events table, in
three rounds with a restart from the checkpoint between them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import case
from checks.sqltext import WINDOW_MS, sql, text
from fraudloom import schemas
from fraudloom.functions.times import instant
from fraudloom.operators import validate
from fraudloom.operators.alerts import load_alert_fact
from fraudloom.operators.profiles import refresh_stats
from fraudloom.operators.trailing import trailing_features
from fraudloom.plans import dashboard
from fraudloom.plans.mart import read_fact
from fraudloom.plans.scoring import fired
from fraudloom.session import work_dir
from fraudloom.sources import archive, backup, csv, ingest, topics
from fraudloom.sources.profilestore import ProfileStore
from fraudloom.streaming import jobs, sinks
from fraudloom.streaming.features import living_state

_ROUNDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
_FOLDERS: dict[tuple[str, str, str], str] = {}


def _once(spark, sf, name, build):
    """Run ``build(folder)`` once per application and test folder."""
    slot = (spark.sparkContext.applicationId, sf, name)
    if slot not in _FOLDERS:
        folder = work_dir(spark, name)
        build(folder)
        _FOLDERS[slot] = folder
    return _FOLDERS[slot]


def drain(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _rounds(spark, sf):
    """The transactions in three consecutive pieces."""
    edges = [0, *[int(instant(t).timestamp() * 1000) for t in _ROUNDS], 2**62]
    tx, ts = fx.transactions(spark, sf), F.col("ingestion_timestamp_ms")
    return [tx.where((ts >= a) & (ts < b)) for a, b in zip(edges, edges[1:])]


def _topic(spark, sf):
    def build(folder):
        topics.send(topics.publishable(topics.evenly(fx.transactions(spark, sf))), folder)
    return _once(spark, sf, "topic", build)


def _incoming(spark, folder, start="latest"):
    """Decoded transactions of a topic folder, as a stream."""
    messages = topics.read_topic(spark, folder, start)
    return topics.readable(topics.decode_messages(messages))


def _scoring(spark, sf):
    """Output folder of the scoring job after three rounds, folders merged and profiles written back after each."""
    def build(base):
        source, store = f"{base}/source", ProfileStore(spark, f"{base}/profiles", buckets=4)
        store.create(fx.profiles(spark, sf))
        for piece in _rounds(spark, sf):
            topics.send(topics.publishable(topics.evenly(piece)), source)
            drain(jobs.score_stream(
                spark, _incoming(spark, source), base, lambda _: fx.blacklist(spark, sf), store.lookup, fx.FIXTURE))
            jobs.compact(spark, base, idle_days=60)
            jobs.write_back_profiles(spark, base, store)
        jobs.close_profiles(spark, base, store)
    return _once(spark, sf, "scoring", build)


def _rollup(spark, sf):
    def build(base):
        source = f"{base}/source"
        for piece in _rounds(spark, sf):
            topics.send(topics.publishable(topics.evenly(piece)), source)
            # test folders are replayed file by file in any order, hence the long lateness
            drain(jobs.upsert_stream(
                jobs.hourly_rollup(_incoming(spark, source), "60 days"), base, "summaries"))
            jobs.compact_upserts(spark, base, "summaries", ["summary_hour", "transaction_type"])
    return _once(spark, sf, "rollup", build)


# ---- files and topics -------------------------------------------------------------
_TX = "select step, type, amount, nameOrig, nameDest, isFraud, isFlaggedFraud from tx"


def _csv(spark, sf):
    def build(folder):
        raw = fx.transactions(spark, sf).drop("ingestion_timestamp_ms", "seq")
        raw.withColumn("unused", F.lit("extra")).write.option("header", True).csv(folder)
    return _once(spark, sf, "csv", build)


@case("s1_csv_scan", sql("tx", _TX))
def _(spark, sf):
    rows = validate.valid(validate.check(csv.read_csv(spark, _csv(spark, sf))))
    return rows.select("step", "type", "amount", "nameOrig", "nameDest", "isFraud", "isFlaggedFraud")


def _replayed(spark, sf):
    """CSV files, validated and published, scored as a stream, loaded into the mart."""
    def build(base):
        sent = ingest.publish_csv(spark, _csv(spark, sf), f"{base}/source", instant("2024-01-01 00:00:00"))
        spark.createDataFrame([sent], "sent bigint, skipped bigint").write.parquet(f"{base}/counters")
        drain(jobs.score_stream(
            spark, _incoming(spark, f"{base}/source"), base,
            lambda _: fx.blacklist(spark, sf), lambda _: fx.profiles(spark, sf), fx.FIXTURE,
            lambda alerts, batch_id: topics.send(alerts, f"{base}/alert_messages")))
        jobs.load_alerts(spark, base, f"{base}/fact")
    return _once(spark, sf, "replayed", build)


@case("s1_csv_to_alerts", sql("scored", f"""
select {text("event_ts")} as alert_ts, cast(strftime(event_ts, '%Y%m%d') as bigint) as date_key,
  nameOrig as card_id, nameDest as dest_id, type as transaction_type, amount, rules as rules_triggered,
  score_e4 / 10000.0 as risk_score, isFraud as is_fraud_label, isFlaggedFraud as is_flagged_fraud,
  'PENDING' as review_status from fired""", replayed=True))
def _(spark, sf):
    """The whole chain: every row of the mart's fact, but for the number given on arrival."""
    fact = read_fact(spark, f"{_replayed(spark, sf)}/fact", schemas.FRAUD_ALERTS)
    return fact.drop("alert_id", "reviewed_by", "reviewed_at", "created_at")


@case("s1_csv_alert_ids", sql("scored", """
select (select count(*) from tx) as sent, 0 as skipped, count(*) as alerts, count(*) as ids from fired""",
    replayed=True))
def _(spark, sf):
    """Ingest counters, and as many different alert ids as alerts."""
    base = _replayed(spark, sf)
    fact = read_fact(spark, f"{base}/fact", schemas.FRAUD_ALERTS)
    ids = fact.agg(F.count(F.lit(1)).alias("alerts"), F.countDistinct("alert_id").alias("ids"))
    return spark.read.parquet(f"{base}/counters").crossJoin(ids)  # one row each


@case("s7_alert_messages", sql("scored", """
select nameOrig as card_id, amount, type, rules as rules_triggered, score_e4 / 10000.0 as risk_score,
  isFraud as is_fraud_label, ingestion_timestamp_ms as alert_ts_ms from fired""", replayed=True))
def _(spark, sf):
    """Alerts as the scoring stream sent them to a topic."""
    sent = spark.read.parquet(f"{_replayed(spark, sf)}/alert_messages")
    return sent.select(F.from_json("value", schemas.ALERT).alias("alert")).select("alert.*")


@case("s7_alerts_once", sql("scored", """
select nameOrig as card_id, amount, type, rules as rules_triggered, score_e4 / 10000.0 as risk_score,
  isFraud as is_fraud_label, ingestion_timestamp_ms as alert_ts_ms from fired"""))
def _(spark, sf):
    """What a consumer gets of a topic to which every second batch was sent twice."""
    def build(base):
        sent = sinks.read_batches(spark, _scoring(spark, sf), "alert_topic")
        for batch in (sent, sent.where("batch_id % 2 = 0")):
            topics.send(batch.select("key", "value"), f"{base}/topic")
        incoming = topics.read_topic(spark, f"{base}/topic", schema="key binary, value string")
        drain(topics.read_alerts(incoming, "60 days").writeStream.format("parquet")
              .option("path", f"{base}/alerts").option("checkpointLocation", f"{base}/checkpoint"))
    return spark.read.parquet(f"{_once(spark, sf, 'alerts_once', build)}/alerts").drop("alert_id", "alert_ts")


@case("s5_partitioned_event_numbers", sql("scored", """
select (seq % 4) * 281474976710656 + seq // 4 as alert_id, nameOrig as card_id, nameDest as dest_id from fired"""))
def _(spark, sf):
    """Alert facts of messages from four partitions whose offsets are equal."""
    number = topics.event_number(F.col("seq") % 4, F.expr("seq div 4"))
    fact = load_alert_fact(fired(fx.scored(spark, sf)).withColumn("seq", number))
    return fact.select("alert_id", "card_id", "dest_id")


@case("s4_keyed_publish", sql("tx", """
select seq, nameOrig as card_key, 0 as magic, 1 as schema_id from tx"""))
def _(spark, sf):
    messages = topics.publishable(fx.transactions(spark, sf))
    return messages.select(
        "seq", F.decode("key", "UTF-8").alias("card_key"),
        F.conv(F.hex(F.substring("value", 1, 1)), 16, 10).cast("bigint").alias("magic"),
        F.conv(F.hex(F.substring("value", 2, 4)), 16, 10).cast("bigint").alias("schema_id"))


@case("s5_event_stream", sql("tx", "select seq, nameOrig, type, amount, ingestion_timestamp_ms from tx"))
def _(spark, sf):
    source = _topic(spark, sf)

    def build(base):
        stream = _incoming(spark, source)
        drain(stream.writeStream.format("parquet").option("path", f"{base}/rows")
              .option("checkpointLocation", f"{base}/checkpoint"))
    rows = spark.read.parquet(f"{_once(spark, sf, 'event_stream', build)}/rows")
    return rows.select("seq", "nameOrig", "type", "amount", "ingestion_timestamp_ms")


def _damaged(spark, sf):
    """Messages of which some are empty, short, foreign or cut off, by event number."""
    number, value = F.col("seq"), F.col("value")
    broken = (
        F.when(number % 10 == 1, F.lit(b""))
        .when(number % 10 == 2, F.substring(value, 1, 5))
        .when(number % 10 == 3, F.concat(F.lit(b"\x01"), F.substring(value, 2, 1_000_000)))
        .when(number % 10 == 4, F.expr("substring(value, 1, length(value) - 9)"))
        .otherwise(value)
    )
    return topics.publishable(fx.transactions(spark, sf)).withColumn("value", broken)


@case("s6_envelope_decode", sql("tx", """
select seq, case when seq % 10 in (1, 2, 3, 4) then null else nameOrig end as card,
  case when seq % 10 in (1, 2, 3, 4) then null else amount end as amount from tx"""))
def _(spark, sf):
    return topics.decode_messages(_damaged(spark, sf)).select(
        "seq", F.col("tx.nameOrig").alias("card"), F.col("tx.amount").alias("amount"))


@case("p1_drop_undecodable", sql("tx", "select seq, nameOrig, amount from tx where seq % 10 not in (1, 2, 3, 4)"))
def _(spark, sf):
    return topics.readable(topics.decode_messages(_damaged(spark, sf))).select("seq", "nameOrig", "amount")


# ---- archive ----------------------------------------------------------------------
_HOURS = """select strftime(event_ts, '%Y') as year, strftime(event_ts, '%m') as month,
  strftime(event_ts, '%d') as day, strftime(event_ts, '%H') as hour, count(*) as n,
  cast(sum(cents) as bigint) / 100.0 as amount from tx group by 1, 2, 3, 4"""


def _by_hour(spark, folder):
    return spark.read.parquet(folder).groupBy(*archive.PARTS).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"))


def _archive(spark, sf):
    return _once(spark, sf, "archive", lambda folder: archive.archive(fx.transactions(spark, sf), folder))


@case("s9_archive_by_hour", sql("tx", _HOURS))
def _(spark, sf):
    return _by_hour(spark, _archive(spark, sf))


@case("s8_archive_stream", sql("tx", _HOURS))
def _(spark, sf):
    source = _topic(spark, sf)

    def build(base):
        drain(archive.archive_stream(
            _incoming(spark, source, "earliest"), f"{base}/archive", f"{base}/checkpoint"))
    return _by_hour(spark, f"{_once(spark, sf, 'archive_stream', build)}/archive")


@case("s11_archive_replay", sql("tx", """
select seq, nameOrig, amount, ingestion_timestamp_ms from tx
where event_ts >= timestamp '2024-01-10 06:30:00' and event_ts < timestamp '2024-01-12 18:15:00'"""))
def _(spark, sf):
    rows = archive.replay(
        spark, _archive(spark, sf), instant("2024-01-10 06:30:00"), instant("2024-01-12 18:15:00"))
    return rows.select("seq", "nameOrig", "amount", "ingestion_timestamp_ms")


def _differing(left, right):
    """The rows of either side that the other lacks, as often as it lacks them: ``exceptAll`` both ways, each side read once."""
    sides = left.withColumn("_side", F.lit(1)).union(right.select(*left.columns).withColumn("_side", F.lit(-1)))
    odd = sides.groupBy(*left.columns).agg(F.sum("_side").alias("_side")).where("_side <> 0")
    return odd.withColumn("_side", F.explode(F.sequence(F.lit(1), F.abs("_side")))).drop("_side")


# ---- backup -----------------------------------------------------------------------
_TAKEN = instant("2024-01-31 00:30:00")
_TAKEN_MS = int(_TAKEN.timestamp() * 1000)


@case("s14_table_rows", sql("prof", f"""
select substr(md5(card_id), 1, 2) || '_' || card_id || '_' || year_month as row_key, card_id,
  cast(credit_limit as varchar) as limit_text, last_city, cast(null as varchar) as currency,
  {_TAKEN_MS} as backup_ts from prof"""))
def _(spark, sf):
    rows = backup.to_rows("user_profiles", fx.profiles(spark, sf), _TAKEN_MS)

    def cell(name):
        return F.try_element_at("columns", F.lit(name))
    return rows.select(
        "row_key", cell("account:card_id").alias("card_id"), cell("account:credit_limit").alias("limit_text"),
        cell("geo:last_city").alias("last_city"), cell("account:currency").alias("currency"), "backup_ts")


def _sources(spark, sf):
    return {
        "blacklist": fx.blacklist(spark, sf),
        "user_profiles": fx.profiles(spark, sf),
        "fraud_alerts": fx.mart(spark, sf)["fraud_alerts"].select(
            F.col("rules_triggered").alias("rules"), F.col("risk_score").cast("double").alias("risk_score"),
            F.unix_millis("alert_ts").alias("ts"), F.col("card_id").alias("nameOrig"),
            F.col("amount").cast("double").alias("amount"), F.col("transaction_type").alias("type"),
            F.col("dest_id").alias("nameDest")),
    }


def _backup(spark, sf):
    """Backup folder; its manifest is stored beside the tables."""
    def build(base):
        entries = backup.write_backup(spark, _sources(spark, sf), base, _TAKEN)
        entries.write.parquet(f"{base}/manifest")
    return _once(spark, sf, "backup", build)


_ROWS = """, entries as (
  select 'blacklist' as "table", count(*) as rows from bl union all select 'user_profiles', count(*) from prof
  union all select 'fraud_alerts', count(*) from fa)"""


@case("s15_backup_write", sql("fa prof bl", f"{_ROWS} select * from entries"))
def _(spark, sf):
    base = _backup(spark, sf)
    return backup.manifest({
        table: spark.read.schema(schemas.BACKUP).parquet(backup.backup_path(base, "2024-01-31", table))
        for table in backup.FAMILIES
    }).select("table", "rows")


@case("s16_backup_manifest", sql("fa prof bl", f"""{_ROWS}
select "table", rows, 'OK' as status, '2024-01-31' as backup_date from entries"""))
def _(spark, sf):
    return spark.read.parquet(f"{_backup(spark, sf)}/manifest")


@case("s16_backup_summary", sql("fa prof bl", f"""{_ROWS}
select cast(sum(rows) as bigint) as total_rows, 1 as success, 'OK' as reason from entries"""))
def _(spark, sf):
    return backup.summarize(spark.read.parquet(f"{_backup(spark, sf)}/manifest"))


@case("s17_restore", sql("prof", "select card_id, year_month, credit_limit, avg_amount, last_city from prof"))
def _(spark, sf):
    path = backup.backup_path(_backup(spark, sf), "2024-01-31", "user_profiles")
    stored = spark.read.schema(schemas.BACKUP).parquet(path)
    return backup.restore("user_profiles", stored, schemas.USER_PROFILES).select(
        "card_id", "year_month", "credit_limit", "avg_amount", "last_city")


@case("s17_restore_round_trip", sql("bl", "select card_id, is_active from bl where false"))
def _(spark, sf):
    """Rows that differ between the table and its restored copy: none."""
    path = backup.backup_path(_backup(spark, sf), "2024-01-31", "blacklist")
    stored = spark.read.schema(schemas.BACKUP).parquet(path)
    restored = backup.restore("blacklist", stored, schemas.BLACKLIST).select("card_id", "is_active")
    source = fx.blacklist(spark, sf)
    return _differing(source, restored)


@case("s17_restore_all_tables", sql("bl", 'select card_id as "table", 0 as differing from bl where false'))
def _(spark, sf):
    """Tables with rows that differ between source and restored copy, over all columns: none."""
    base, differing = _backup(spark, sf), []
    for table, source in _sources(spark, sf).items():
        stored = spark.read.schema(schemas.BACKUP).parquet(backup.backup_path(base, "2024-01-31", table))
        restored = backup.restore(table, stored, source.schema).select(*source.columns)
        differing.append(_differing(source, restored).select(F.lit(table).alias("table")))
    first, second, third = differing
    return first.unionAll(second).unionAll(third).groupBy("table").agg(F.count(F.lit(1)).alias("differing"))


@case("s18_backup_retention", sql("tx", """
select strftime(event_ts, '%Y-%m-%d') as backup_date, type as "table", count(*) as rows from tx
where cast(event_ts as date) < date '2024-04-15' - interval 90 day group by 1, 2"""))
def _(spark, sf):
    """One backup per day and transaction type."""
    day = F.date_format(F.timestamp_millis("ingestion_timestamp_ms"), "yyyy-MM-dd")
    daily = fx.transactions(spark, sf).groupBy(day.alias("backup_date"), F.col("type").alias("table")).agg(
        F.count(F.lit(1)).alias("rows"))
    return backup.expired(daily, instant("2024-04-15 00:00:00"))


# ---- streams ----------------------------------------------------------------------
@case("x2_stateful_features", sql("feat", "select seq, nameOrig, n_window, hv_window, prev_ts from feat"))
def _(spark, sf):
    features = sinks.read_batches(spark, _scoring(spark, sf), "scored")
    return features.select("seq", "nameOrig", "n_window", "hv_window", "prev_ts")


@case("x2_stream_equals_batch", sql("tx", "select seq from tx where false"))
def _(spark, sf):
    """Rows on which the stream and the batch disagree: none."""
    columns = ["nameOrig", "seq", "n_window", "hv_window", "prev_ts"]
    stream = sinks.read_batches(spark, _scoring(spark, sf), "scored").select(*columns)
    batch = trailing_features(fx.transactions(spark, sf), fx.FIXTURE).select(*columns)
    return _differing(stream, batch).select("seq")


def _late_scoring(spark, sf):
    """Scoring in three rounds, of which the second brings a fifth of the first one's events."""
    def build(base):
        source = f"{base}/source"
        first, second, third = _rounds(spark, sf)
        held = F.col("seq") % 5 == 0
        for piece in (first.where(~held), second.unionByName(first.where(held)), third):
            topics.send(topics.publishable(topics.evenly(piece)), source)
            drain(jobs.score_stream(
                spark, _incoming(spark, source), base,
                lambda _: fx.blacklist(spark, sf), lambda _: fx.profiles(spark, sf), fx.FIXTURE))
    return _once(spark, sf, "late", build)


_LATE = f""", arriving as (
  select seq, nameOrig, ingestion_timestamp_ms as ms, large,
    case when event_ts >= timestamp '2024-01-21' then 3 when event_ts >= timestamp '2024-01-11' then 2
      when seq % 5 = 0 then 2 else 1 end as piece from tx
), seen as (
  select e.seq, e.ms, e.piece, max(p.ms) as newest_before
  from arriving e left join arriving p on p.nameOrig = e.nameOrig and p.piece < e.piece group by all
), late as (
  select seq, coalesce(ms + 10000 < newest_before, false) as is_late,
    greatest(ms, coalesce(newest_before, 0)) - {WINDOW_MS} as kept_from from seen
), counts as (
  select e.seq, cast(l.is_late as bigint) as is_late, count(*) as n_window,
    cast(sum(p.large) as bigint) as hv_window
  from arriving e join late l on l.seq = e.seq join arriving p on p.nameOrig = e.nameOrig
    and ((p.piece < e.piece and p.ms >= l.kept_from)
      or (p.piece = e.piece and p.ms >= e.ms - {WINDOW_MS} and (p.ms, p.seq) <= (e.ms, e.seq)))
  group by all
)"""


@case("x3_late_events", sql("tx", f"""{_LATE}
select count(*) as events, cast(sum(is_late) as bigint) as late from counts"""))
def _(spark, sf):
    features = sinks.read_batches(spark, _late_scoring(spark, sf), "scored")
    return features.agg(F.count(F.lit(1)).alias("events"), F.count_if("is_late").alias("late"))


@case("x3_late_windows", sql("tx", f"{_LATE} select seq, is_late, n_window, hv_window from counts"))
def _(spark, sf):
    """Late events are judged against what earlier rounds left, newer events included."""
    return sinks.read_batches(spark, _late_scoring(spark, sf), "scored").select(
        "seq", "is_late", "n_window", "hv_window")


@case("x9_stored_alerts", sql("scored", """
select nameOrig, ingestion_timestamp_ms as ts, rules, score_e4 / 10000.0 as risk_score, amount from fired"""))
def _(spark, sf):
    return jobs.stored_alerts(spark, _scoring(spark, sf)).select("nameOrig", "ts", "rules", "risk_score", "amount")


@case("x7_restart_no_duplicates", sql("scored", """
select count(*) as alerts, count(distinct nameOrig || '_' || ingestion_timestamp_ms) as distinct_alerts,
  3 as batches from fired"""))
def _(spark, sf):
    """Each round restarted the job from its checkpoint."""
    base = _scoring(spark, sf)
    alerts = sinks.read_batches(spark, base, "alerts")
    batches = sinks.read_batches(spark, base, "scored").select("batch_id").distinct()
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"), F.countDistinct("row_key").alias("distinct_alerts")
    ).crossJoin(batches.agg(F.count(F.lit(1)).alias("batches")))  # one row each


@case("s7_alert_topic", sql("scored", """
select nameOrig as card_id, amount, type, rules as rules_triggered, score_e4 / 10000.0 as risk_score,
  isFraud as is_fraud_label, ingestion_timestamp_ms as alert_ts_ms from fired"""))
def _(spark, sf):
    published = sinks.read_batches(spark, _scoring(spark, sf), "alert_topic")
    return published.select(F.from_json("value", schemas.ALERT).alias("alert")).select("alert.*")


@case("x11_stream_lookups", sql("scored", """
select seq, is_active, credit_limit, last_city, rules as rules_triggered from scored"""))
def _(spark, sf):
    return sinks.read_batches(spark, _scoring(spark, sf), "scored").select(
        "seq", "is_active", "credit_limit", "last_city", "rules_triggered")


_WRITTEN_BACK = """
select nameOrig as card_id, ym as year_month, arg_max(amount, seq) as last_amount,
  max(ingestion_timestamp_ms) as last_tx_ts from scored {} group by 1, 2"""


def _store(spark, sf):
    return ProfileStore(spark, f"{_scoring(spark, sf)}/profiles")


@case("s22_stream_write_back", sql("scored", _WRITTEN_BACK.format("")))
def _(spark, sf):
    return _store(spark, sf).read().where("last_tx_ts is not null").select(
        "card_id", "year_month", "last_amount", "last_tx_ts")


@case("s22_older_version", sql("scored", _WRITTEN_BACK.format("where event_ts < timestamp '2024-01-21'")))
def _(spark, sf):
    """The version before the last one: two rounds written back."""
    store = _store(spark, sf)
    return store.read(store.versions.newest() - 1).where("last_tx_ts is not null").select(
        "card_id", "year_month", "last_amount", "last_tx_ts")


@case("a12_merged_stats", sql("feat", """
select nameOrig as card_id, ym as year_month, arg_max(n_window, seq) as tx_count_5m,
  arg_max(window_cents, seq) / 100.0 as amount_sum_5m,
  round((cast(sum(cents) as bigint) / 100.0) / count(*), 6) as avg_amount from feat group by 1, 2"""))
def _(spark, sf):
    """Statistics carried from round to round in the profile versions, never recomputed from transactions."""
    merged = refresh_stats(_store(spark, sf).read()).where("tx_n > 0")
    return merged.select("card_id", "year_month", "tx_count_5m", "amount_sum_5m", F.round("avg_amount", 6).alias("avg_amount"))


@case("x4_state_expiry", sql("tx", f"""
, last as (select nameOrig, max(ingestion_timestamp_ms) as newest from tx group by 1)
select l.nameOrig, l.newest, count(*) as n_kept from last l join tx t on t.nameOrig = l.nameOrig
  and t.ingestion_timestamp_ms >= l.newest - {WINDOW_MS}
where l.newest >= (select max(newest) from last) - 2 * 86400000 group by 1, 2"""))
def _(spark, sf):
    """Tails left after cards idle for two days are dropped: their newest event and the events of their last window."""
    tails = living_state(sinks.read_batches(spark, _scoring(spark, sf), "tails"), 2)
    return tails.where("month is null").groupBy("nameOrig").agg(
        F.max("at").alias("newest"), F.sum("n").alias("n_kept"))


_SUMMARY = """select strftime(summary_hour, '%Y-%m-%d %H:%M:%S.%f') as summary_hour, transaction_type,
  total_transactions, total_cents / 100.0 as total_amount, avg_cents / 100.0 as avg_amount,
  max_cents / 100.0 as max_amount, fraud_count, fraud_cents / 100.0 as fraud_amount,
  rate_e4 / 10000.0 as fraud_rate_pct, alerts_generated from ts"""


@case("x5_hourly_rollup", sql("ts", _SUMMARY))
def _(spark, sf):
    alerts = fx.mart(spark, sf)["fraud_alerts"]
    return jobs.stored_summaries(spark, _rollup(spark, sf), "summaries", alerts).drop(
        "summary_id", "date_key", "created_at")


@case("x6_minute_throughput", sql("tx", f"""
select {text("date_trunc('minute', event_ts)")} as bucket, count(*) as total_transactions,
  cast(sum(isFraud) as bigint) as fraud_transactions from tx group by 1"""))
def _(spark, sf):
    source = _topic(spark, sf)

    def build(base):
        drain(jobs.upsert_stream(jobs.minute_throughput(_incoming(spark, source)), base, "minutes"))
    base = _once(spark, sf, "minutes", build)
    jobs.compact_upserts(spark, base, "minutes", ["bucket"])
    return sinks.latest_by_key(sinks.read_batches(spark, base, "minutes"), ["bucket"])


@case("x1_watermark_closes_hours", sql("tx", """
select count(*) as closed_hours from (
  select distinct date_trunc('hour', event_ts) as h, type from tx
  where date_trunc('hour', event_ts) + interval 1 hour <=
    (select max(event_ts) from tx where event_ts < timestamp '2024-01-21') - interval 10 second)"""))
def _(spark, sf):
    """Append mode: an hour appears once the watermark has passed its end.

    The watermark of a round takes effect with the next one: after all rounds,
    what is closed is all that ended 10 seconds before the newest event of the
    last but one.
    """
    def build(base):
        source = f"{base}/source"
        for piece in _rounds(spark, sf):
            topics.send(topics.publishable(topics.evenly(piece)), source)
            drain(jobs.hourly_rollup(_incoming(spark, source)).writeStream.format("parquet")
                  .option("path", f"{base}/hours").option("checkpointLocation", f"{base}/checkpoint")
                  .outputMode("append"))
    hours = spark.read.parquet(f"{_once(spark, sf, 'closed_hours', build)}/hours")
    return hours.agg(F.count(F.lit(1)).alias("closed_hours"))


def _delivery(spark, sf):
    source = _topic(spark, sf)
    return _once(spark, sf, "delivery", lambda base: drain(
        jobs.dashboard_stream(_incoming(spark, source), base, lambda payload: 202)))


@case("s12_dashboard_stream", sql("feed", """
select "Transaction_ID", "Time", "Amount", "Status", score_e2 / 100.0 as "Score" from feed"""))
def _(spark, sf):
    """Every row as the receiver got it, out of the delivered payloads."""
    outcome = sinks.read_batches(spark, _delivery(spark, sf), "delivery").where("delivered")
    row = "Transaction_ID string, Time string, Amount double, Status string, Score double"
    rows = F.from_json("payload_json", f"rows array<struct<{row.replace(' string', ': string').replace(' double', ': double')}>>")
    return outcome.select(F.explode(rows["rows"]).alias("row")).select("row.*")


@case("x10_replayed_batch", sql("feed", """
, secs as (select cast(floor(epoch(event_ts)) as bigint) as s, count(*) as n from feed group by 1)
select 'first' as run, cast(sum((n + 19) // 20) as bigint) as sent, cast(sum(n) as bigint) as n_rows from secs
union all select 'replay', 0, cast(sum(n) as bigint) from secs"""))
def _(spark, sf):
    """A batch delivered, lost before its outcome was stored, and delivered again: nothing is sent twice."""
    payloads = dashboard.push_payloads(fx.mart(spark, sf)["feed"])
    claims, runs = work_dir(spark, "claims"), []
    for run in ("first", "replay"):
        path = work_dir(spark, "delivery")
        sinks.deliver(payloads, lambda payload: 200, claims=claims).write.parquet(path)
        outcome = spark.read.parquet(path)
        runs.append(outcome.agg(
            F.lit(run).alias("run"), F.sum("attempts").alias("sent"), F.sum("n_rows").alias("n_rows")))
    return runs[0].unionByName(runs[1])


@case("x10_dropped_payloads", sql("feed", """, secs as (
  select cast(floor(epoch(event_ts)) as bigint) as s, max("isFraud") as refused, count(*) as n from feed group by 1)
select cast(refused = 0 as bigint) as delivered, case when refused = 1 then 4 else 1 end as attempts,
  cast(sum(n) as bigint) as n_rows from secs group by 1, 2"""))
def _(spark, sf):
    """The receiver never accepts a payload with a blocked transaction."""
    def send(payload: str) -> int:
        return 500 if '"Status":"Blocked"' in payload else 200

    payloads = dashboard.push_payloads(fx.mart(spark, sf)["feed"])
    outcome = sinks.deliver(payloads, send, pauses=(0.0, 0.0, 0.0))
    return outcome.groupBy("delivered", "attempts").agg(F.sum("n_rows").alias("n_rows"))
