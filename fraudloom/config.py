"""Rule thresholds, code lists and job settings.

The lists in this module are fixed values: results only agree with the
published rule and table definitions if they stay exactly as written.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: transaction domain --------------------------------------
TRANSACTION_TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN")
SYSTEM_FLAG_TYPE = "TRANSFER"
SYSTEM_FLAG_AMOUNT = 200_000.0

# ---- fixed values: rule codes in the order they are evaluated ---------------
R1, R2, R5 = "R1_BLACKLIST", "R2_CREDIT_LIMIT", "R5_BEHAVIORAL_ANOMALY"
R3, R4, R6 = "R3_GEO_VELOCITY", "R4_HIGH_VALUE_BURST", "R6_VELOCITY_BURST"
RULE_SCORES = {R1: 1.0, R2: 0.9, R5: 0.75, R3: 0.85, R4: 0.8, R6: 0.7}
UNKNOWN_CITY = "UNKNOWN"
FLAG_ABOVE_SCORE = 0.5

# ---- fixed values: mart domains and seeds -----------------------------------
REVIEW_STATUSES = ("PENDING", "CONFIRMED_FRAUD", "FALSE_POSITIVE", "UNDER_REVIEW")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
METRIC_STATUSES = ("OK", "WARNING", "CRITICAL", "UNKNOWN")
EVENT_SEVERITIES = ("INFO", "WARNING", "ERROR", "CRITICAL")
DOMAINS = {
    ("dim_transaction_type", "type_name"): TRANSACTION_TYPES,
    ("dim_rule", "severity"): SEVERITIES,
    ("fraud_alerts", "review_status"): REVIEW_STATUSES,
    ("pipeline_health_metrics", "status"): METRIC_STATUSES,
    ("pipeline_events", "severity"): EVENT_SEVERITIES,
}
TYPE_SEEDS = (
    ("PAYMENT", "Point-of-sale or online payment"),
    ("TRANSFER", "Account-to-account transfer"),
    ("CASH_OUT", "ATM or cash withdrawal"),
    ("DEBIT", "Direct debit charge"),
    ("CASH_IN", "Cash deposit"),
)
RULE_SEEDS = (
    (R1, "Blacklist Hit", "CRITICAL", "Card found in HBase blacklist — immediate reject"),
    (R2, "Credit Limit Breach", "HIGH", "Transaction amount exceeds cardholder credit limit"),
    (R3, "Geographic Velocity", "HIGH", "Multiple locations within 5-minute window"),
    (R4, "High-Value Burst", "HIGH", "3+ large transactions within 5-minute window"),
    (R5, "Behavioral Anomaly", "MEDIUM", "Amount > 5× user rolling average"),
    (R6, "Velocity Burst", "MEDIUM", "10+ transactions within 5-minute window"),
)

# ---- fixed values: dashboard -------------------------------------------------
COUNTRIES = ("Egypt", "India", "USA", "Brazil", "UK")
DASHBOARD_RULES = (
    "Geographic Velocity",
    "Card Testing",
    "High Amount",
    "Blacklisted Card",
    "Velocity (Time)",
)
HIGH_AMOUNT = 2000.0
FRAUD_RATE_TARGET = 0.007
GAUGE_MAX = 0.01
SEVERITY_BANDS = (("Critical", 0.95), ("High", 0.85), ("Medium", 0.5))
COMPONENTS = ("Kafka", "Flink", "HBase", "HDFS", "Airflow")
PUSH_ROWS = 20
LAG_THRESHOLD = 100_000
HEALTHY_JOB_STATES = ("RUNNING", "FINISHED")

# ---- fixed values: retention (days, None = for ever) and kept versions -------
RETENTION = {
    ("blacklist", "info"): (None, 1),
    ("blacklist", "audit"): (730, 5),
    ("user_profiles", "account"): (None, 1),
    ("user_profiles", "stats"): (90, 3),
    ("user_profiles", "geo"): (30, 10),
    ("user_profiles", "risk"): (180, 20),
    ("fraud_alerts", "alert"): (365, 1),
    ("fraud_alerts", "tx"): (365, 1),
}
BACKUP_RETENTION_DAYS = 90

# ---- fixed values: amounts are DECIMAL(18,2) in the mart ----------------------
AMOUNT_BELOW = 1e16


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the six rules, and how large cards are split.

    A card with more than ``hot_card_rows`` transactions is spread over time
    slots of ``slot_ms``. The list of such cards has at most one entry per
    ``hot_card_rows`` rows: 500,000 for 10^12 transactions.
    """

    window_ms: int = 300_000
    geo_ms: int = 300_000
    high_value: float = 10_000.0
    burst_high_value: int = 3
    burst_count: int = 10
    anomaly_factor: float = 5.0
    hot_card_rows: int = 2_000_000
    slot_ms: int = 60_000
