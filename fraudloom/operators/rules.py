"""The six fraud rules as column expressions over looked-up, featured rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom import config
from fraudloom.config import RuleConfig
from fraudloom.functions.parsing import city_proxy


def rule_hits(cfg: RuleConfig = RuleConfig()) -> dict[str, Column]:
    """Rule code to condition, in the order in which codes are reported.

    Every missing lookup value makes its rule false. NaN amounts never exceed
    anything: Spark orders NaN above all numbers, hence the explicit test.
    """
    amount = F.when(~F.isnan("amount"), F.col("amount"))
    limit, average = F.col("credit_limit"), F.col("avg_amount")
    last_ts = F.coalesce("prev_ts", "last_tx_ts", F.lit(0))
    moved = ~F.col("last_city").isin(config.UNKNOWN_CITY) & (
        F.col("last_city") != city_proxy(F.col("nameDest"))
    )
    return {
        config.R1: F.col("is_active") == "1",
        config.R2: (limit > 0) & (amount > limit),
        config.R5: (average > 0) & (amount > cfg.anomaly_factor * average),
        config.R3: moved & (F.col("ingestion_timestamp_ms") - last_ts < cfg.geo_ms),
        config.R4: F.col("hv_window") >= cfg.burst_high_value,
        config.R6: F.col("n_window") >= cfg.burst_count,
    }


def evaluate(df: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Adds ``rules_triggered`` (array), ``risk_score`` and ``flagged``.

    Needs the lookup columns (is_active, credit_limit, avg_amount, last_city,
    last_tx_ts) and the feature columns (n_window, hv_window, prev_ts). The same
    function serves batch rows and streaming micro-batches.
    """
    hits = rule_hits(cfg)
    codes = F.array(*[F.when(hit, code).otherwise("") for code, hit in hits.items()])
    scores = [F.when(hit, config.RULE_SCORES[code]) for code, hit in hits.items()]
    return df.withColumns({
        "rules_triggered": F.array_remove(codes, ""),
        "risk_score": F.greatest(F.lit(0.0), *scores),
    }).withColumn("flagged", F.col("risk_score") > config.FLAG_ABOVE_SCORE)
