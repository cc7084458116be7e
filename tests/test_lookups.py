"""Lookup tables that hold several versions of a row."""

from pyspark.sql import functions as F

from fraudloom.operators.reference import PROFILE_FIELDS, attach_reference
from fraudloom.plans.scoring import score

JAN, FEB = 1_704_067_200_000, 1_706_745_600_000


def tables(spark):
    blacklist = spark.createDataFrame(
        [("C1", "1", "2024-01-01"), ("C1", "0", "2024-01-02"), ("C2", "0", None), ("C2", "1", "2024-01-01"),
         (None, "1", "2024-01-01")],
        "card_id string, is_active string, version_ts string").withColumn("version_ts", F.to_timestamp("version_ts"))
    profiles = spark.createDataFrame(
        [("C1", "202401", 10.0, "2024-01-01"), ("C1", "202401", 20.0, "2024-01-03"), ("C1", "202402", 30.0, "2024-02-01"),
         ("C1", None, 40.0, "2024-01-04"), (None, "202401", 50.0, "2024-01-05")],
        "card_id string, year_month string, credit_limit double, version_ts string").withColumn(
        "version_ts", F.to_timestamp("version_ts"))
    return blacklist, profiles


def test_newest_version_counts_in_batch_and_stream(spark, tx_of):
    tx = tx_of(("C1", JAN, 1, 5.0), ("C1", FEB, 2, 5.0), ("C2", JAN, 3, 5.0), ("C3", JAN, 4, 5.0))
    columns = ["seq", "is_active", *PROFILE_FIELDS]
    batch = score(tx, *tables(spark)).select(columns).orderBy("seq").collect()
    stream = attach_reference(tx, *tables(spark)).select(columns).orderBy("seq").collect()
    assert batch == stream
    assert [(r.seq, r.is_active, r.credit_limit) for r in batch] == [
        (1, "0", 20.0), (2, "0", 30.0), (3, "1", None), (4, None, None)]


def test_versions_without_stamp_do_not_multiply_rows(spark, tx_of):
    blacklist, profiles = (t.drop("version_ts") for t in tables(spark))
    tx = tx_of(("C1", JAN, 1, 5.0))
    for out in (score(tx, blacklist, profiles), attach_reference(tx, blacklist, profiles)):
        assert [(r.is_active, r.credit_limit) for r in out.collect()] == [("1", 20.0)]
