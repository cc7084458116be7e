"""Dashboard feed and its measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom import config
from fraudloom.functions import dashboard as fn
from fraudloom.functions import times

FEED_COLUMNS = (
    "Time", "Transaction_ID", "Card_Mask", "Amount", "Country", "Status", "Score", "Rule", "isFraud",
)


def enrich(tx: DataFrame) -> DataFrame:
    """Feed rows. Every value follows from the event itself."""
    key = F.concat_ws(
        ":", "nameOrig", F.col("ingestion_timestamp_ms").cast("string"), F.col("seq").cast("string")
    )
    fraud = F.coalesce("isFraud", F.lit(0))
    amount = F.coalesce("amount", F.lit(0.0))
    return tx.select(
        times.iso_micros(F.col("ingestion_timestamp_ms")).alias("Time"),
        fn.transaction_id(key).alias("Transaction_ID"),
        fn.card_mask(F.col("nameOrig")).alias("Card_Mask"),
        amount.alias("Amount"),
        fn.country(F.col("nameOrig")).alias("Country"),
        fn.status(fraud).alias("Status"),
        fn.score(fraud, key).alias("Score"),
        fn.rule(fraud, amount, key).alias("Rule"),
        fraud.alias("isFraud"),
    )


def _iso(instant: Column) -> Column:
    """An instant in the text form of ``Time``, which sorts like time itself."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _is_fraud() -> Column:
    return F.col("isFraud") == 1


def within(feed: DataFrame, as_of: datetime, newest: str, oldest: str) -> DataFrame:
    """Rows between ``oldest`` and ``newest`` before ``as_of``, as a range on the stored text."""
    return feed.where(_between(as_of, newest, oldest))


def _between(as_of: datetime, newest: str, oldest: str) -> Column:
    start = _iso(F.lit(as_of) - F.expr(f"INTERVAL {oldest}"))
    end = _iso(F.lit(as_of) - F.expr(f"INTERVAL {newest}"))
    return (F.col("Time") > start) & (F.col("Time") <= end)


def last_hour(feed: DataFrame, as_of: datetime) -> DataFrame:
    return within(feed, as_of, "0 HOURS", "1 HOURS")


def latest_transactions(feed: DataFrame, limit: int = 50) -> DataFrame:
    """The stream table: newest first."""
    return (
        feed.select(*FEED_COLUMNS[:-1])
        .orderBy(F.desc("Time"), "Transaction_ID").limit(limit)
    )


def _measures(condition: Column | None = None) -> dict[str, Column]:
    """The five card measures, optionally over the rows that meet a condition."""
    def rows(value: Column) -> Column:
        return value if condition is None else F.when(condition, value)

    total = F.count(rows(F.lit(1)))
    fraud = F.count(rows(F.when(_is_fraud(), 1)))
    blocked = F.when(F.col("Status") == "Blocked", F.col("Amount").try_cast("decimal(18,2)"))
    return {
        "total_transactions": total,
        "fraud_transactions": fraud,
        "fraud_rate": F.try_divide(fraud, total),
        # decimals add up exactly, whatever the order of the partitions
        "average_score": F.avg(rows(F.col("Score").cast("decimal(5,2)"))),
        "loss_prevented": F.sum(rows(blocked)),
    }


def card_measures(feed: DataFrame) -> DataFrame:
    """Totals, fraud rate (blank over no rows), mean score and loss prevented."""
    return feed.agg(*[value.alias(name) for name, value in _measures().items()])


def fraud_gauge(feed: DataFrame) -> DataFrame:
    """Fraud rate against its target, on the gauge's scale."""
    target = F.lit(config.FRAUD_RATE_TARGET)
    return feed.agg(_measures()["fraud_rate"].alias("fraud_rate")).select(
        "fraud_rate",
        target.alias("target"),
        F.lit(0.0).alias("scale_min"),
        F.lit(config.GAUGE_MAX).alias("scale_max"),
        (F.col("fraud_rate") > target).alias("above_target"),
    )


def throughput(feed: DataFrame) -> DataFrame:
    """Transactions per second between the first and the last; blank if both are equal."""
    seconds = F.unix_seconds(F.to_timestamp(F.max("Time"))) - F.unix_seconds(
        F.to_timestamp(F.min("Time"))
    )
    return feed.agg(F.try_divide(F.count(F.lit(1)), seconds).alias("tps"))


def throughput_buckets(feed: DataFrame, width: str = "1 minute") -> DataFrame:
    """All and fraudulent transactions per time bucket."""
    return (
        feed.groupBy(F.window(F.to_timestamp("Time"), width).start.alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_if(_is_fraud()).alias("fraud_transactions"),
        )
    )


def versus_last_hour(feed: DataFrame, as_of: datetime) -> DataFrame:
    """Each card measure of the last hour, of the hour before, and the change in percent.

    One pass over two hours of the feed.
    """
    now, before = _between(as_of, "0 HOURS", "1 HOURS"), _between(as_of, "1 HOURS", "2 HOURS")
    both = within(feed, as_of, "0 HOURS", "2 HOURS").agg(
        *[v.cast("double").alias(f"{n}_now") for n, v in _measures(now).items()],
        *[v.cast("double").alias(f"{n}_before") for n, v in _measures(before).items()],
    )
    out = []
    for name in _measures():
        new, old = F.col(f"{name}_now"), F.col(f"{name}_before")
        out += [new, old, F.try_divide(100 * (new - old), old).alias(f"{name}_delta_pct")]
    return both.select(*out)


def fraud_by_country(feed: DataFrame) -> DataFrame:
    return feed.groupBy("Country").agg(F.count_if(_is_fraud()).alias("fraud_transactions"))


def top_rules(feed: DataFrame) -> DataFrame:
    """Fraud count per rule and its share of all rules' fraud, 'None' left out."""
    per_rule = feed.groupBy("Rule").agg(F.count_if(_is_fraud()).alias("fraud_transactions"))
    # at most one row per rule name is left here, so one task suffices
    share = F.try_divide(F.col("fraud_transactions"), F.sum("fraud_transactions").over(Window.partitionBy()))
    return (
        per_rule.withColumn("rule_share", share)
        .transform(named_rules)
        .orderBy(F.desc("fraud_transactions"), "Rule")
    )


def named_rules(rows: DataFrame) -> DataFrame:
    """Rows of a rule; 'None' stands for transactions that none stopped."""
    return rows.where("Rule <> 'None'")


def severity_counts(feed: DataFrame) -> DataFrame:
    return feed.groupBy(fn.severity(F.col("Score")).alias("severity")).agg(
        F.count(F.lit(1)).alias("n")
    )


def push_payloads(
    feed: DataFrame, batch_size: int = config.PUSH_ROWS, flush_seconds: int = 1, id_digits: int = 2,
) -> DataFrame:
    """Feed rows packed into ``{"rows": [...]}`` texts of at most ``batch_size`` rows.

    A batch closes when it is full or when its flush interval ends. Rows are
    numbered in the order of time, id, mask and amount within their interval. No
    task sorts a whole interval: rows are counted per slot, which is a time stamp
    and the first ``id_digits`` hex digits of the id, the counts are added up, and
    a row's number is what earlier slots hold plus its place in its own slot. An
    interval has at most 1,000 * 16^id_digits slots a second. The digits only
    change the grain of the work, never the payloads. Rows without time share
    the null interval.
    """
    never = F.lit(-(2**63))
    slot = ["_interval", "_time", "_id"]
    rows = feed.withColumns({
        "_interval": F.coalesce(F.expr(f"unix_seconds(to_timestamp(Time)) div {flush_seconds}"), never),
        "_time": F.coalesce("Time", F.lit("")),
        "_id": F.substring(F.coalesce("Transaction_ID", F.lit("")), 1, len("TXN-") + id_digits),
    })
    earlier = Window.partitionBy("_interval").orderBy("_time", "_id").rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy(*slot).agg(F.count(F.lit(1)).alias("_held"))
    opening = held.select(*slot, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    order = Window.partitionBy(*slot).orderBy("Transaction_ID", "Card_Mask", "Amount")
    return (
        rows.join(opening, slot)
        .withColumn("_row", F.col("_before") + F.row_number().over(order))
        .groupBy("_interval", F.expr(f"(_row - 1) div {batch_size}").alias("_batch"))
        .agg(F.sort_array(F.collect_list(F.struct(*feed.columns))).alias("rows"))
        .select(
            F.nullif("_interval", never).alias("flush_interval"),
            F.to_json(F.struct("rows")).alias("payload_json"),
            F.size("rows").alias("n_rows"),
        )
    )
