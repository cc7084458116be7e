"""Headline timings as one JSON line.

BENCH_SF_DIR names the test folder, BENCH_CPUS the number of local cores. Every
batch query is run twice to completion (results go to the noop sink) and the
faster run counts; stream and mart build are run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import cases_io, fixtures  # noqa: E402
from fraudloom.operators import validate  # noqa: E402
from fraudloom.operators.trailing import trailing_features  # noqa: E402
from fraudloom.plans import dashboard, kpi, mart  # noqa: E402
from fraudloom.plans.scoring import fired  # noqa: E402
from fraudloom.session import local_session  # noqa: E402


def _batch(spark, sf):
    tx = fixtures.transactions(spark, sf)
    tables = fixtures.mart(spark, sf)
    alerts, summaries = tables["fraud_alerts"], tables["transaction_summaries"]
    return {
        "alerts_six_rules": lambda: fired(fixtures.scored(spark, sf)),
        "trailing_features": lambda: trailing_features(tx, fixtures.FIXTURE),
        "trailing_features_hot_cards": lambda: trailing_features(tx, fixtures.ALL_HOT),
        "validate_raw_rows": lambda: validate.valid(validate.check(_raw(tx))),
        "hourly_summary": lambda: mart.hourly_summary(tx, alerts),
        "dashboard_feed": lambda: dashboard.enrich(tx),
        "kpi_top_cards": lambda: kpi.top_cards(alerts, fixtures.AS_OF),
        "kpi_rule_frequency": lambda: kpi.rule_frequency(alerts, tables["dim_rule"]),
        "kpi_daily_summary": lambda: kpi.daily_summary(summaries, tables["dim_date"], fixtures.AS_OF),
        "kpi_review_queue": lambda: kpi.review_queue(alerts),
        "kpi_health_summary": lambda: kpi.health_summary(tables["pipeline_health_metrics"]),
        "push_payloads": lambda: dashboard.push_payloads(tables["feed"], flush_seconds=3600),
    }


def _raw(tx):
    from fraudloom import schemas
    return tx.select(*[tx[c].cast("string") for c in schemas.RAW_CSV.names])


def _run(build) -> float:
    began = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    events = fixtures.transactions(spark, sf).count()

    seconds: dict[str, float] = {}
    began = time.perf_counter()
    fixtures.mart(spark, sf)
    seconds["mart_build"] = time.perf_counter() - began
    for name, build in _batch(spark, sf).items():
        seconds[name] = min(_run(build) for _ in range(2))
    began = time.perf_counter()
    cases_io._scoring(spark, sf)
    seconds["stream_scoring_three_rounds"] = time.perf_counter() - began

    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(json.dumps({
        "metric": "card_fraud_headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "events": events,
        "alerts_events_per_sec": round(events / seconds["alerts_six_rules"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
