"""Declared schemas; nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {
    "string": T.StringType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "decimal(5,4)": T.DecimalType(5, 4),
    "decimal(8,4)": T.DecimalType(8, 4),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(22,2)": T.DecimalType(22, 2),
}


def _table(columns: str) -> StructType:
    """'name type, ...' as a schema. Unlike fromDDL it needs no running session."""
    pairs = [column.split(maxsplit=1) for column in columns.split(", ")]
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_CSV_COLUMNS = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
)

RAW_CSV = _table(", ".join(f"{c} string" for c in _CSV_COLUMNS))

TRANSACTION = _table(
    "step int, type string, amount double, nameOrig string, oldbalanceOrg double, "
    "newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, "
    "isFraud int, isFlaggedFraud int, ingestion_timestamp_ms bigint"
)

# seq is the arrival order (log offset) and breaks ties between equal time stamps
SEQUENCED = StructType([*TRANSACTION.fields, T.StructField("seq", T.LongType())])

# The payload contract of the transaction topic, as Avro JSON.
TRANSACTION_AVRO = """{
  "type": "record", "name": "Transaction", "namespace": "fraudloom",
  "fields": [
    {"name": "step", "type": "int"},
    {"name": "type", "type": {"type": "enum", "name": "TransactionType",
      "symbols": ["PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN"]}},
    {"name": "amount", "type": "double"},
    {"name": "nameOrig", "type": "string"},
    {"name": "oldbalanceOrg", "type": "double"},
    {"name": "newbalanceOrig", "type": "double"},
    {"name": "nameDest", "type": "string"},
    {"name": "oldbalanceDest", "type": "double"},
    {"name": "newbalanceDest", "type": "double"},
    {"name": "isFraud", "type": "int"},
    {"name": "isFlaggedFraud", "type": "int"},
    {"name": "ingestion_timestamp_ms", "type": "long"}
  ]
}"""

BLACKLIST = _table(
    "card_id string, block_reason string, is_active string, "
    "blacklisted_at timestamp, source string, analyst_id string"
)

USER_PROFILES = _table(
    "card_id string, year_month string, credit_limit double, currency string, "
    "tx_count_5m bigint, amount_sum_5m double, avg_amount double, last_country string, "
    "last_city string, last_tx_ts bigint, last_amount double, score double, flagged string"
)

ALERT = _table(
    "card_id string, amount double, type string, rules_triggered array<string>, "
    "risk_score double, is_fraud_label int, alert_ts_ms bigint"
)

FRAUD_ALERTS = _table(
    "alert_id bigint, alert_ts timestamp, date_key int, card_id string, dest_id string, "
    "transaction_type string, amount decimal(18,2), rules_triggered string, "
    "risk_score decimal(5,4), is_fraud_label tinyint, is_flagged_fraud tinyint, "
    "review_status string, reviewed_by string, reviewed_at timestamp, created_at timestamp"
)

TRANSACTION_SUMMARIES = _table(
    "summary_id bigint, summary_hour timestamp, date_key int, transaction_type string, "
    "total_transactions bigint, total_amount decimal(22,2), avg_amount decimal(18,2), "
    "max_amount decimal(18,2), fraud_count int, fraud_amount decimal(18,2), "
    "fraud_rate_pct decimal(8,4), alerts_generated int, created_at timestamp"
)

HEALTH_METRICS = _table(
    "metric_id bigint, recorded_at timestamp, date_key int, component string, "
    "metric_name string, metric_value double, unit string, status string, detail string"
)

PIPELINE_EVENTS = _table(
    "event_id bigint, event_ts timestamp, date_key int, event_type string, component string, "
    "severity string, dag_run_id string, task_id string, message string"
)

BACKUP = _table("row_key string, columns map<string,string>, backup_ts bigint")
