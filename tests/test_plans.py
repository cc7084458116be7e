"""Physical plans: exchanges, join kinds, pruning."""

import re

import pytest
from helpers import SF, plan_of

from checks import fixtures as fx
from fraudloom.functions.times import instant
from fraudloom.operators.reference import card_reference
from fraudloom.operators.trailing import trailing_features
from fraudloom.plans import kpi, mart
from fraudloom.plans.scoring import score
from fraudloom.session import work_dir
from fraudloom.sources import archive


@pytest.fixture()
def no_broadcast(spark):
    """Join sides as large as they would be at scale."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stored_inputs(spark):
    """Inputs as plain files, so that plans show the operators alone."""
    base = work_dir(spark, "plans")
    out = []
    for name, df in (
        ("tx", fx.transactions(spark, SF)), ("bl", fx.blacklist(spark, SF)), ("pr", fx.profiles(spark, SF)),
    ):
        df.write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


def test_scoring_moves_transactions_once(spark, no_broadcast):
    plan = plan_of(score(*stored_inputs(spark)))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(nameOrig" in line and "_slot" in line]
    # transactions, lookups, and the slot totals of hot cards
    assert len(wide) == 3
    assert "SortMergeJoin [nameOrig" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_only_the_bounded_key_list_is_broadcast(spark, no_broadcast):
    plan = plan_of(score(*stored_inputs(spark)))
    for block in plan.split("BroadcastExchange")[1:]:
        assert "n_rows" in block and "> 2000000)" in block


def test_unused_columns_are_not_read(spark):
    tx, bl, pr = stored_inputs(spark)
    plan = plan_of(trailing_features(tx).select("seq", "n_window"))
    assert not re.search(r"ReadSchema: struct<[^>]*(newbalanceOrig|nameDest)", plan)


def test_rule_frequency_needs_no_nested_loop_over_alerts(spark):
    tables = fx.mart(spark, SF)
    plan = plan_of(kpi.rule_frequency(tables["fraud_alerts"], tables["dim_rule"]))
    # the only nested loop attaches the one-row total
    assert plan.count("NestedLoopJoin") <= 1 and "find_in_set" not in plan
    assert "HashAggregate(keys=[rules_triggered" in plan


def test_top_lists_are_not_sorted_globally(spark):
    tables = fx.mart(spark, SF)
    for df in (kpi.review_queue(tables["fraud_alerts"]), kpi.top_cards(tables["fraud_alerts"], fx.AS_OF)):
        assert "TakeOrderedAndProject" in plan_of(df) and "rangepartitioning" not in plan_of(df)


def test_latest_health_is_cut_down_before_the_exchange(spark):
    assert "WindowGroupLimit" in plan_of(mart.latest_health(fx.mart(spark, SF)["pipeline_health_metrics"]))


def test_replay_prunes_folders(spark):
    base = work_dir(spark, "replay")
    archive.archive(fx.transactions(spark, SF).where("step <= 48"), base)
    df = archive.replay(spark, base, instant("2024-01-01 05:00:00"), instant("2024-01-01 07:00:00"))
    assert re.search(r"PartitionFilters: \[[^\]]*concat\(year", plan_of(df))
    assert df.count() == fx.transactions(spark, SF).where(
        "ingestion_timestamp_ms >= 1704085200000 and ingestion_timestamp_ms < 1704092400000").count()


def test_replay_of_ingest_time_folders(spark):
    base = work_dir(spark, "replay")
    archive.archive(fx.transactions(spark, SF).where("step <= 48"), base, partition_time="ingest")
    df = archive.replay(
        spark, base, instant("2024-01-01 05:00:00"), instant("2024-01-01 07:00:00"), partition_time="ingest")
    assert df.count() == fx.transactions(spark, SF).where(
        "ingestion_timestamp_ms >= 1704085200000 and ingestion_timestamp_ms < 1704092400000").count() > 0


def test_card_reference_is_unique(spark):
    side = card_reference(fx.blacklist(spark, SF), fx.profiles(spark, SF))
    assert side.count() == side.select("nameOrig").distinct().count()
