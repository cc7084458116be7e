"""State across batches: late events, restart, replay."""

import random
import uuid
from collections import Counter
from decimal import Decimal

import pytest
from helpers import T0, plan_of
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.config import RuleConfig
from fraudloom.operators.trailing import trailing_features
from fraudloom.sources import archive, topics
from fraudloom.sources.profilestore import ProfileStore
from fraudloom.sources.versions import Versions
from fraudloom.streaming import features, jobs, sinks

CFG = RuleConfig()


class Feed:
    """A topic folder that is filled and drained round by round."""

    def __init__(self, spark, tx_of, folder):
        self.spark, self.tx_of = spark, tx_of
        self.source, self.base = f"{folder}/source", f"{folder}/out"
        self.listed = spark.createDataFrame([("C9", "1")], "card_id string, is_active string")
        self.known = spark.createDataFrame([], "card_id string, year_month string, credit_limit double")

    def push(self, *events):
        topics.publishable(self.tx_of(*events)).write.mode("append").parquet(self.source)
        incoming = topics.readable(topics.decode_messages(topics.read_topic(self.spark, self.source)))
        jobs.score_stream(
            self.spark, incoming, self.base, lambda _: self.listed, lambda _: self.known, CFG
        ).trigger(availableNow=True).start().awaitTermination()

    def features(self):
        return {r.seq: r for r in sinks.read_batches(self.spark, self.base, "scored").collect()}


def test_late_and_restarted_events(spark, tx_of, tmp_path):
    feed = Feed(spark, tx_of, tmp_path)
    minute = 60_000
    feed.push(("C1", T0, 1, 10_000), ("C1", T0 + minute, 2, 1), ("C1", T0 + 4 * minute, 3, 10_000), ("C9", T0, 4, 1))
    # late by more than 10 seconds, yet judged: all kept entries count, newer ones too
    feed.push(("C1", T0 + 2 * minute, 5, 1), ("C1", T0 + 6 * minute, 6, 10_000), ("C2", T0, 7, 1))
    got = feed.features()
    assert {s: (r.n_window, r.hv_window) for s, r in got.items() if r.nameOrig == "C1"} == {
        1: (1, 1), 2: (2, 1), 3: (3, 2), 5: (4, 2), 6: (4, 2)}
    assert [got[s].is_late for s in (3, 5, 6, 7)] == [False, True, False, False]
    # arrival order: the event before the late one is number 3
    assert (got[5].prev_ts, got[6].prev_ts) == (T0 + 4 * minute, T0 + 2 * minute)
    alerts = jobs.stored_alerts(spark, feed.base).collect()
    assert [(a.nameOrig, a.rules) for a in alerts] == [("C9", "R1_BLACKLIST")]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([("k", 1)], "k string, v int")
    sinks.write_batch(df, base, "t", 0)
    sinks.write_batch(df, base, "t", 0)
    sinks.write_batch(spark.createDataFrame([("k", 2), ("l", 3)], "k string, v int"), base, "t", 1)
    table = sinks.read_batches(spark, base, "t")
    assert table.count() == 3
    assert sorted(map(tuple, sinks.latest_by_key(table, ["k"]).collect())) == [("k", 2), ("l", 3)]




def test_batch_that_fails_inside_is_done_again_once(spark, tx_of, tmp_path):
    """The job dies after everything but the alerts was written; the restart publishes them, and nothing else twice."""
    source, base, sent = f"{tmp_path}/source", f"{tmp_path}/out", []
    listed = spark.createDataFrame([("C9", "1")], "card_id string, is_active string")
    known = spark.createDataFrame([], "card_id string, year_month string, credit_limit double")
    fail = [True]

    def publish(messages, batch_id):
        if fail.pop():
            raise RuntimeError("receiver is down")
        sent.extend(r.key for r in messages.collect())

    def run():
        incoming = topics.readable(topics.decode_messages(topics.read_topic(spark, source)))
        jobs.score_stream(spark, incoming, base, lambda _: listed, lambda _: known, CFG, publish).trigger(
            availableNow=True).start().awaitTermination()

    topics.publishable(tx_of(("C9", T0, 1, 1), ("C9", T0 + 1, 2, 1))).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="receiver is down"):
        run()
    fail.append(False)
    run()
    topics.publishable(tx_of(("C9", T0 + 2, 3, 1))).write.mode("append").parquet(source)
    fail.append(False)
    run()
    assert len(sent) == len(set(sent)) == 3
    scored = {r.seq: r.n_window for r in sinks.read_batches(spark, base, "scored").collect()}
    assert scored == {1: 1, 2: 2, 3: 3}  # the replay did not count its own events twice
    assert sinks.finished_batches(spark, base, "arrived") == [1]


@pytest.mark.parametrize("hot_card_rows, slot_ms, hot_cards", [
    (2_000_000, 60_000, True), (2_000_000, 60_000, False), (1, 1_000, True)])
def test_tail_equals_batch_features_over_random_rounds(spark, tx_of, hot_card_rows, slot_ms, hot_cards):
    rnd = random.Random(5)
    cfg = RuleConfig(window_ms=4_000, hot_card_rows=hot_card_rows, slot_ms=slot_ms)
    events = sorted((T0 + rnd.randint(0, 40_000), seq, f"C{rnd.randint(0, 2)}", rnd.choice([5, 20_000, float("nan")])) for seq in range(150))
    state, got = spark.createDataFrame([], features.STATE), {}
    for at in range(0, 150, 50):
        tx = tx_of(*[(card, ts, seq, amount) for ts, seq, card, amount in events[at:at + 50]])
        for r in features.batch_features(tx, state, cfg, hot_cards=hot_cards).collect():
            got[r.seq] = (r.n_window, r.hv_window, r.amount_window, r.prev_ts)
        # cards without events keep their rows: here all cards are in the state
        state = spark.createDataFrame(features.next_state(tx, state, cfg).collect(), features.STATE)
    whole = tx_of(*[(card, ts, seq, amount) for ts, seq, card, amount in events])
    expected = trailing_features(whole, cfg, amounts=True).collect()
    assert got == {r.seq: (r.n_window, r.hv_window, r.amount_window, r.prev_ts) for r in expected}


def test_job_splits_batches_with_more_rows_than_make_a_hot_card(spark, tx_of, tmp_path):
    listed = spark.createDataFrame([], schemas.BLACKLIST)
    known = spark.createDataFrame([], schemas.USER_PROFILES)
    seen = []
    for rows in (1, 1_000):
        cfg, base = RuleConfig(window_ms=4_000, hot_card_rows=rows, slot_ms=1_000), str(tmp_path / str(rows))
        for batch in range(2):
            tx = tx_of(*[("C1", T0 + 700 * i, i, 20_000) for i in range(batch * 9, batch * 9 + 9)], ("C2", T0 + batch, 50 + batch, 1))
            jobs.score_batch(spark, tx, batch, base, lambda _: listed, lambda _: known, cfg)
        scored = sinks.read_batches(spark, base, "scored").select("seq", "n_window", "hv_window", "prev_ts", "rules_triggered")
        seen.append(sorted(scored.collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 20
    assert {r.seq: r.n_window for r in seen[0]}[17] == 6


def test_idle_cards_leave_the_tails(spark):
    day = 86_400_000
    rows = [("C1", None, T0, 1, 0, None, 0), ("C1", None, T0 + 9 * day, 1, 0, None, 1), ("C1", "202401", T0 + 9 * day, 0, 0, None, 1),
            ("C2", None, T0 + 6 * day, 2, 0, None, 0), ("C2", "202401", T0 + 6 * day, 0, 0, None, 0), ("C3", None, T0 + 7 * day, 1, 0, None, 0)]
    left = features.living_state(spark.createDataFrame(rows, f"{features.STATE}, batch_id bigint"), 2).collect()
    assert sorted((r.nameOrig, r.month, r.at) for r in left if r.month is None) == [("C1", None, T0 + 9 * day), ("C3", None, T0 + 7 * day)]
    assert [r.nameOrig for r in left if r.month] == ["C1"]


def test_merged_batches(spark, tmp_path):
    base, schema = str(tmp_path), "k string, v int"

    def write(number, *rows):
        sinks.write_batch(spark.createDataFrame(list(rows), schema), base, "t", number)

    def folders():
        files = sinks.read_batches(spark, base, "t").inputFiles()
        return sorted({f.rsplit("/", 2)[1] for f in files})

    assert sinks.read_batches(spark, base, "t", schema=schema).count() == 0
    assert not sinks.merge_batches(spark, base, "t", schema=schema)
    for number in range(3):
        write(number, ("a", number), (f"only-{number}", number))
    assert sinks.merge_batches(spark, base, "t", lambda rows: sinks.newest_rows(rows, ["k"]))
    assert folders() == ["0000000000-0", "batch_id=2"]  # the newest may still be replayed
    assert not sinks.merge_batches(spark, base, "t")
    write(2, ("a", 20))
    write(3, ("b", 3))
    expected = {"a": 20, "b": 3, "only-0": 0, "only-1": 1}
    assert dict(map(tuple, sinks.latest_by_key(sinks.read_batches(spark, base, "t"), ["k"]).collect())) == expected
    before = sinks.read_batches(spark, base, "t")
    assert sinks.merge_batches(spark, base, "t", lambda rows: sinks.newest_rows(rows, ["k"]))
    assert folders() == ["0000000001-0", "batch_id=3"]
    assert before.count() == 5 and sorted(before.columns) == ["batch_id", "k", "v"]  # its files are still there
    assert dict(map(tuple, sinks.latest_by_key(sinks.read_batches(spark, base, "t"), ["k"]).collect())) == expected
    assert sinks.finished_batches(spark, base, "t") == [2, 3]
    assert {r.batch_id for r in sinks.read_batches(spark, base, "t", after=0, before=3).collect()} == {1, 2}


def test_growing_tables_are_merged_by_levels(spark, tmp_path):
    base = str(tmp_path)
    for number in range(9):
        sinks.write_batch(spark.createDataFrame([(number,)], "v int"), base, "t", number)
        sinks.merge_batches(spark, base, "t", fan_in=3)
        assert sorted(r.v for r in sinks.read_batches(spark, base, "t").collect()) == list(range(number + 1))
    versions = Versions(spark, f"{base}/t.versions")
    assert [level for _, level in versions.read(versions.newest())["folders"]] == [1, 1, 0, 0]
    kept = {path for path, _ in versions.read(versions.newest())["folders"]}
    assert {f"{base}/t.merged/{p.name}" for p in (tmp_path / "t.merged").iterdir()} == kept
    assert sinks.read_batches(spark, base, "t", after=3, before=6).count() == 2


def test_a_version_is_published_once(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.newest() is None
    versions.publish(0, {"a": 1})
    with pytest.raises(Exception, match="(?i)exist"):
        versions.publish(0, {"a": 2})
    assert versions.read(0) == {"a": 1} and versions.numbers() == [0]


# ---- profile versions ---------------------------------------------------------------
ACTIVITY = ("card_id string, year_month string, last_amount double, score double, flagged string, last_tx_ts bigint, "
            "tx_count_5m bigint, amount_sum_5m double, tx_total decimal(22,2), tx_n bigint, batch_id bigint")


def activity(spark, *rows):
    return spark.createDataFrame(
        [(card, month, float(at), 0.7, "1", at, at, float(at), Decimal(total), n, batch) for card, month, at, total, n, batch in rows],
        ACTIVITY)


def test_write_back_copies_only_touched_parts(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"), buckets=8)
    cards = [f"C{i}" for i in range(40)]
    store.create(spark.createDataFrame(
        [(c, m, 5.0, "Rome") for c in cards for m in ("202401", "202402")] + [(None, "202401", 1.0, None)],
        "card_id string, year_month string, credit_limit double, last_city string"))
    assert store.read().count() == 80
    one = activity(spark, ("C1", "202401", 7, "10.50", 2, 0), ("C1", "202401", 9, "4.50", 1, 1), ("new", "202403", 3, "1", 1, 1))
    store.write_back(one, 1, averages=True)
    row = store.read().where("card_id = 'C1' and year_month = '202401'").first()
    assert (row.credit_limit, row.last_city, row.last_amount, row.tx_count_5m, row.tx_n, row.avg_amount) == (5.0, "Rome", 9.0, 9, 3, 5.0)
    assert store.read().count() == 81 and store.read(0).count() == 80 and store.upto() == 1
    assert store.read(0).where("last_amount is not null").count() == 0
    parts = ProfileStore(spark, str(tmp_path / "p")).versions.read(1)["parts"]
    assert sum(n == 1 for n in parts.values()) == 2 and len(parts) > 10
    store.write_back(activity(spark, ("C1", "202401", 12, "5", 1, 2)), 2)
    assert store.read().where("card_id = 'C1' and tx_n = 4 and avg_amount = 5.0 and last_amount = 12").count() == 1
    store.retain(2)
    assert store.versions.numbers() == [1, 2] and store.read().count() == 81 and store.read(1).count() == 81


def test_lookup_opens_the_parts_of_its_cards_and_months(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"), buckets=16)
    store.create(spark.createDataFrame(
        [(f"C{i}", m, float(i)) for i in range(200) for m in ("202401", "202402")], "card_id string, year_month string, credit_limit double"))
    wanted = spark.createDataFrame([("C1", "202402"), ("C999", "202402"), ("C2", "202409"), (None, "202401")], "card_id string, year_month string")
    found = store.lookup(wanted)
    assert [(r.card_id, r.year_month, r.credit_limit) for r in found.collect()] == [("C1", "202402", 1.0)]
    folders = {f.rsplit("/", 2)[0].rsplit("/", 1)[1] + "/" + f.rsplit("/", 2)[1] for f in store.read(parts=store._parts(wanted)).inputFiles()}
    assert len(folders) <= 2 and all("202402" in f for f in folders)
    assert store.lookup(wanted.where("card_id = 'nobody'")).count() == 0


# ---- at-most-once delivery --------------------------------------------------------------
def test_batch_killed_between_sending_and_storing_sends_nothing_twice(spark, tx_of, tmp_path):
    log, base = tmp_path / "sent", f"{tmp_path}/out"
    log.mkdir()

    def send(payload):
        with open(f"{log}/{uuid.uuid4().hex}", "w") as file:
            file.write(payload)
        return 200

    def run():
        incoming = topics.readable(topics.decode_messages(topics.read_topic(spark, f"{tmp_path}/source")))
        jobs.dashboard_stream(incoming, base, send, pauses=()).trigger(availableNow=True).start().awaitTermination()

    topics.publishable(tx_of(*[("C1", T0 + i % 3, i, 1) for i in range(70)])).write.parquet(f"{tmp_path}/source")
    stored, sinks_write = [], jobs.write_batch

    def dying(df, base_, table, batch_id, *rest):
        if table == "delivery" and not stored:
            stored.append(df.collect())  # everything is sent, nothing is stored
            raise RuntimeError("killed")
        return sinks_write(df, base_, table, batch_id, *rest)

    jobs.write_batch = dying
    try:
        with pytest.raises(Exception, match="killed"):
            run()
        run()
    finally:
        jobs.write_batch = sinks_write
    payloads = sorted(f.read_text() for f in log.iterdir())
    assert len(payloads) == 4 and len(set(payloads)) == 4
    outcome = sinks.read_batches(spark, base, "delivery").collect()
    assert sum(r.n_rows for r in outcome) == 70 and {(r.delivered, r.attempts) for r in outcome} == {(False, 0)}


def test_equal_payloads_are_each_sent(spark, tmp_path):
    payloads = spark.createDataFrame([("{}", 1)] * 3 + [("[]", 2)], "payload_json string, n_rows int")
    first = sinks.deliver(payloads, lambda _: 200, claims=f"{tmp_path}/claims").collect()
    again = sinks.deliver(payloads, lambda _: 200, claims=f"{tmp_path}/claims").collect()
    assert [r.attempts for r in first] == [1] * 4 and [r.attempts for r in again] == [0] * 4


# ---- archive --------------------------------------------------------------------------
def test_archive_files_follow_the_size_of_an_hour(spark, tx_of, tmp_path):
    many = spark.range(200_000).select("id").crossJoin(tx_of(("C1", T0, 1, 1)).drop("seq", "nameOrig"))
    tx = many.withColumns({"seq": F.col("id"), "nameOrig": F.concat(F.lit("C"), F.md5(F.col("id").cast("string")))}).drop("id")
    small = tx_of(*[("C1", T0 + 3_600_000 * h, h, 1) for h in range(1, 5) for _ in range(9)])
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        for _ in range(2):  # the second time is a replay
            archive.archive(tx.select(small.columns).unionByName(small).repartition(12), str(tmp_path), load="batch-0")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = Counter(f.split("hour=")[1][:2] for f in archive.replay(spark, str(tmp_path)).inputFiles())
    assert files["00"] >= 3 and all(files[f"0{h}"] == 1 for h in range(1, 5))
    assert archive.replay(spark, str(tmp_path)).count() == 200_036


def test_alerts_sent_again_are_read_once(spark, tmp_path):
    rows = [("k1", T0), ("k2", T0 + 5)]
    for batch in (rows, rows[:1], rows):
        messages = spark.createDataFrame(batch, "k string, ts bigint").select(
            F.encode("k", "UTF-8").alias("key"), F.to_json(F.struct(F.col("ts").alias("alert_ts_ms"))).alias("value"))
        topics.send(messages, f"{tmp_path}/topic")
        incoming = topics.read_topic(spark, f"{tmp_path}/topic", schema="key binary, value string")
        topics.read_alerts(incoming).writeStream.format("parquet").option("path", f"{tmp_path}/alerts").option(
            "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.alert_id for r in spark.read.parquet(f"{tmp_path}/alerts").collect()) == ["k1", "k2"]


def test_first_batch_has_no_python_rows_and_states_are_stored_once(spark, tx_of, tmp_path, monkeypatch):
    empty = sinks.read_batches(spark, str(tmp_path), "tails", schema=features.STATE)
    assert "ExistingRDD" not in plan_of(empty) and empty.count() == 0
    assert empty.dtypes == [*spark.createDataFrame([], features.STATE).dtypes, ("batch_id", "bigint")]
    listed, known = spark.createDataFrame([], schemas.BLACKLIST), spark.createDataFrame([], schemas.USER_PROFILES)
    built = []
    monkeypatch.setattr(jobs, "next_state", lambda tx, state, cfg: built.append(plan_of(state)) or features.next_state(tx, state, cfg))
    for batch in range(2):
        jobs.score_batch(spark, tx_of(("C1", T0 + batch, batch, 1)), batch, str(tmp_path), lambda _: listed, lambda _: known, CFG)
    assert not any("Window" in plan for plan in built)  # its rows are read, not chosen again
    assert sinks.finished_batches(spark, str(tmp_path), "state") == []
    assert {r.n_window for r in sinks.read_batches(spark, str(tmp_path), "scored").collect()} == {1, 2}


def test_new_tails_move_only_what_stays_in_the_window(spark, tx_of):
    minute = 60_000
    tx = tx_of(*[("C1", T0 + i * minute, i, 20_000) for i in range(30)], (None, T0, 99, 1))
    old = spark.createDataFrame(
        [("C1", None, T0 - 1, 3, 3, None), ("C1", "202312", T0 - 1, 0, 0, None), ("C2", "202312", T0, 0, 0, None)], features.STATE)
    new = features.next_state(tx, old, CFG)
    assert sorted((r.nameOrig, r.at) for r in new.collect() if r.month is None) == [("C1", T0 + i * minute) for i in range(24, 30)]
    assert sorted((r.nameOrig, r.month, r.at) for r in new.collect() if r.month) == [
        ("C1", "202312", T0 - 1), ("C1", "202401", T0 + 29 * minute), ("C2", "202312", T0)]
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Aggregate [nameOrig"):]
    assert "Join Inner" in window and "_newest" in window.split("Aggregate")[1]  # cut down below the sums, not above
