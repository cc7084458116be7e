"""CSV files to a topic: numbers, stamps, counters, headers."""

import pytest
from helpers import T0
from pyspark.sql import functions as F
from test_validate import GOOD, altered

from fraudloom import schemas
from fraudloom.functions.times import instant
from fraudloom.operators.trailing import trailing_features
from fraudloom.sources import ingest, topics
from fraudloom.sources.csv import read_csv

START = instant("2024-01-01 00:00:00")
HEADER = ",".join(schemas.RAW_CSV.names)


def write(folder, **files):
    for name, rows in files.items():
        (folder / f"{name}.csv").write_text("\n".join([HEADER, *map(",".join, rows)]) + "\n")


def test_published_rows_have_their_own_number_and_hour(spark, tmp_path):
    source, topic = tmp_path / "in", str(tmp_path / "topic")
    source.mkdir()
    write(source, a=[GOOD, altered(step="3"), altered(type="REFUND")], b=[GOOD, altered(step="x")])
    assert ingest.publish_csv(spark, str(source), topic, START) == {"sent": 3, "skipped": 2}
    rows = topics.readable(topics.decode_messages(spark.read.parquet(topic))).collect()
    assert len({r.seq for r in rows}) == 3
    hours = sorted((r.ingestion_timestamp_ms - T0) // 3_600_000 for r in rows)
    assert hours == [0, 0, 2]
    again = str(tmp_path / "again")
    ingest.publish_csv(spark, str(source), again, START)
    assert {r.ingestion_timestamp_ms for r in rows} == {
        r.ingestion_timestamp_ms for r in topics.readable(topics.decode_messages(spark.read.parquet(again))).collect()}
    assert sorted(r.reason for r in ingest.quarantine(spark, str(source)).collect()) == ["step", "type"]


def test_offsets_of_two_partitions_give_different_numbers(spark):
    messages = spark.createDataFrame([(0, 5), (1, 5), (1, 6)], "partition int, offset bigint")
    number = topics.event_number(F.col("partition"), F.col("offset"))
    assert [r[0] for r in messages.select(number).collect()] == [5, 2**48 + 5, 2**48 + 6]


def test_files_with_other_column_order_fail_loudly(spark, tmp_path):
    names = list(schemas.RAW_CSV.names)
    write(tmp_path, a=[GOOD] * 3)
    (tmp_path / "b.csv").write_text(",".join([*names[:-2], names[-1], names[-2]]) + "\n" + ",".join(GOOD) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_event_without_number_is_refused(spark, tx_of):
    with pytest.raises(Exception, match="without seq"):
        trailing_features(tx_of(("C1", T0, None, 1.0))).collect()


def test_messages_of_uneven_files_are_published_evenly(spark, tmp_path):
    """One long file and some short ones: no task encodes most rows, no topic file holds most of them."""
    header = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud"
    (tmp_path / "csv").mkdir()
    for name, rows in (("a", 40_000), ("b", 3), ("c", 3)):
        lines = [f"1,PAYMENT,{i}.5,C{name}{i},1.0,1.0,M{i},0.0,0.0,0,0" for i in range(1, rows + 1)]
        (tmp_path / "csv" / f"{name}.csv").write_text("\n".join([header, *lines, ""]))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        sent = ingest.publish_csv(spark, str(tmp_path / "csv"), f"{tmp_path}/topic", instant("2024-01-01 00:00:00"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", before)
    topic = spark.read.parquet(f"{tmp_path}/topic")
    files = [r["count"] for r in topic.groupBy(F.input_file_name()).count().collect()]
    assert sent == {"sent": 40_006, "skipped": 0} and topic.select("seq").distinct().count() == 40_006
    assert max(files) < 20_000
