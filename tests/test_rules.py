"""Rule borders and reporting order."""

import pytest
from helpers import T0

from fraudloom import config
from fraudloom.config import RuleConfig
from fraudloom.operators.rules import evaluate
from fraudloom.plans.scoring import score

COLUMNS = (
    "amount double, nameDest string, ingestion_timestamp_ms bigint, n_window bigint, hv_window bigint, "
    "prev_ts bigint, is_active string, credit_limit double, avg_amount double, last_city string, last_tx_ts bigint"
)
CALM = dict(
    amount=10.0, nameDest="M01x", ingestion_timestamp_ms=T0, n_window=1, hv_window=0, prev_ts=None,
    is_active=None, credit_limit=None, avg_amount=None, last_city=None, last_tx_ts=None,
)


@pytest.mark.parametrize("change, fires", [
    (dict(is_active="1"), [config.R1]),
    (dict(is_active="0"), []),
    (dict(credit_limit=9.99), [config.R2]),
    (dict(credit_limit=10.0), []),
    (dict(credit_limit=0.0), []),
    (dict(credit_limit=float("inf")), []),
    (dict(credit_limit=9.0, amount=float("nan")), []),
    (dict(avg_amount=1.99), [config.R5]),
    (dict(avg_amount=2.0), []),
    (dict(avg_amount=0.0), []),
    (dict(last_city="M02", prev_ts=T0 - 299_999), [config.R3]),
    (dict(last_city="M02", prev_ts=T0 - 300_000), []),
    (dict(last_city="M02", prev_ts=T0 + 5), [config.R3]),
    (dict(last_city="M02", last_tx_ts=T0 - 1), [config.R3]),
    (dict(last_city="M02", prev_ts=T0 - 300_000, last_tx_ts=T0 - 1), []),
    (dict(last_city="M02"), []),
    (dict(last_city="M01", prev_ts=T0 - 1), []),
    (dict(last_city="UNKNOWN", prev_ts=T0 - 1), []),
    (dict(hv_window=2), []),
    (dict(hv_window=3), [config.R4]),
    (dict(n_window=9), []),
    (dict(n_window=10), [config.R6]),
])
def test_rule_border(spark, change, fires):
    row = {**CALM, **change}
    out = evaluate(spark.createDataFrame([tuple(row.values())], COLUMNS)).first()
    assert out.rules_triggered == fires
    assert out.risk_score == max([config.RULE_SCORES[f] for f in fires], default=0.0)
    assert out.flagged == (out.risk_score > 0.5)


def test_all_rules_report_in_evaluation_order(spark, tx_of):
    tx = tx_of(*[("C1", T0 + i, i, 60_000) for i in range(10)])
    listed = spark.createDataFrame([("C1", "1")], "card_id string, is_active string")
    known = spark.createDataFrame(
        [("C1", "202401", 100.0, 10.0, "XYZ")],
        "card_id string, year_month string, credit_limit double, avg_amount double, last_city string")
    last = score(tx, listed, known, RuleConfig()).where("seq = 9").first()
    assert last.rules_triggered == [config.R1, config.R2, config.R5, config.R3, config.R4, config.R6]
    assert last.risk_score == 1.0


def test_profile_of_another_month_does_not_count(spark, tx_of):
    tx = tx_of(("C1", T0, 1, 60_000))
    listed = spark.createDataFrame([], "card_id string, is_active string")
    known = spark.createDataFrame(
        [("C1", "202312", 100.0)], "card_id string, year_month string, credit_limit double")
    assert score(tx, listed, known).first().rules_triggered == []
