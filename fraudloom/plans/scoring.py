"""Batch scoring: transactions, blacklist and profiles in, scored rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.config import RuleConfig
from fraudloom.operators.reference import card_reference, month_fields
from fraudloom.operators.rules import evaluate
from fraudloom.operators.trailing import trailing_features


def score(
    tx: DataFrame, blacklist: DataFrame, profiles: DataFrame, cfg: RuleConfig = RuleConfig()
) -> DataFrame:
    """Every transaction with features, lookups, fired rules and risk score.

    One exchange of the transactions, on (card, slot), serves the lookup join
    and the window.
    """
    looked_up = trailing_features(
        tx, cfg, reference=card_reference(blacklist, profiles), resolve=month_fields
    )
    return evaluate(looked_up, cfg)


def fired(scored: DataFrame) -> DataFrame:
    """Transactions on which at least one rule fired."""
    return scored.where(F.size("rules_triggered") > 0)
