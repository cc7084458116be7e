"""Raw rows: what is accepted, what is rejected and why."""

import os

import pytest

from fraudloom import schemas
from fraudloom.functions import parsing
from fraudloom.operators import validate
from fraudloom.sources.csv import read_csv, stream_csv
from pyspark.sql import functions as F

GOOD = ("1", "PAYMENT", "9839.64", "C1", "1.5", "0.0", "M1", "0.0", "0.0", "0", "0")


def altered(**changes):
    return tuple(changes.get(name, value) for name, value in zip(schemas.RAW_CSV.names, GOOD))


@pytest.mark.parametrize("row, reason", [
    (GOOD, None),
    (altered(type=" cash_out\t"), None),
    (altered(type="REFUND"), "type"),
    (altered(type=None), "type"),
    (altered(amount="x"), "amount"),
    (altered(amount="1e3"), None),
    (altered(amount="5d"), "amount"),
    (altered(amount="0x10p1"), "amount"),
    (altered(amount="-inf"), "amount"),
    (altered(amount="nan"), "amount"),
    (altered(amount="1e17"), "amount"),
    (altered(amount="9999999999999998"), None),
    (altered(step="1.0"), "step"),
    (altered(step=" 7 "), None),
    (altered(nameDest=None), "nameDest"),
    (altered(isFraud=""), "isFraud"),
])
def test_row(spark, row, reason):
    checked = validate.check(spark.createDataFrame([row], schemas.RAW_CSV))
    assert checked.first().reason == reason
    assert validate.valid(checked).count() == (reason is None)
    assert validate.rejected(checked).count() == (reason is not None)


def test_parsed_values(spark):
    row = altered(type=" debit ", step=" 7 ", nameOrig=" C9\n")
    out = validate.valid(validate.check(spark.createDataFrame([row], schemas.RAW_CSV), F.lit(5))).first()
    assert (out.type, out.step, out.nameOrig, out.ingestion_timestamp_ms) == ("DEBIT", 7, "C9", 5)


def test_numbers(spark):
    df = spark.createDataFrame([("inf",), ("NaN",), (" 1.5 ",), ("1.",), (".5",), ("1f",), ("",)], "t string")
    got = [r[0] for r in df.select(parsing.to_double(F.col("t"))).collect()]
    assert got[0] == float("inf") and got[1] != got[1]
    assert got[2:] == [1.5, 1.0, 0.5, None, None]


def test_csv_by_header_name_short_and_long_rows(spark, tmp_path):
    names = list(schemas.RAW_CSV.names)
    swapped = [names[1], names[0], *names[2:], "extra"]
    good = dict(zip(names, GOOD), extra="zzz")
    lines = [",".join(swapped), ",".join(good[n] for n in swapped), "PAYMENT,1,5.0"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    checked = validate.check(read_csv(spark, str(tmp_path)))
    assert [r.nameOrig for r in validate.valid(checked).collect()] == ["C1"]
    assert validate.ingest_counts(checked).first().asDict() == {"sent": 1, "skipped": 1}


def test_csv_stream_is_paced(spark, tmp_path):
    source = tmp_path / "in"
    os.makedirs(source)
    for i in range(3):
        (source / f"{i}.csv").write_text(",".join(schemas.RAW_CSV.names) + "\n" + ",".join(GOOD) + "\n")
    rows = validate.valid(validate.check(stream_csv(spark, str(source), files_per_trigger=1)))
    query = (
        rows.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert sum(p["numInputRows"] == 1 for p in query.recentProgress) == 3


def test_system_flag_default_threshold(spark):
    df = spark.createDataFrame(
        [("TRANSFER", 200_000.0, 0), ("TRANSFER", 200_000.01, 0), ("CASH_OUT", 3e5, 0), ("TRANSFER", 1.0, 1)],
        "type string, amount double, isFlaggedFraud int")
    assert sorted(r.amount for r in validate.flag_mismatches(df).collect()) == [1.0, 200_000.01]
