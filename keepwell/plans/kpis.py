"""Daily channel KPIs and their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from keepwell import fixed_values as fixed
from keepwell.functions.money import cents, from_cents, guarded_ratio


def executive_kpis(transactions: DataFrame) -> DataFrame:
    """One row per day and channel, unsorted: sort when reading, not before writing."""
    return (
        transactions.select(
            F.to_date("transaction_timestamp").alias("metric_date"),
            "channel",
            "customer_id",
            "is_refund_or_return",
            cents(F.col("gross_amount")).alias("amount"),
        )
        .groupBy("metric_date", "channel")
        .agg(
            F.sum("amount").alias("cents"),
            F.count("amount").alias("priced"),
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_if("is_refund_or_return").alias("refunds"),
        )
        .select(
            "metric_date",
            "channel",
            from_cents(F.col("cents")).alias("total_revenue"),
            "total_transactions",
            "unique_customers",
            guarded_ratio(from_cents(F.col("cents")), F.col("priced")).alias("avg_order_value"),
            guarded_ratio(F.col("refunds"), F.col("total_transactions")).alias("refund_return_rate"),
        )
    )


def daily_partials(transactions: DataFrame) -> DataFrame:
    """Mergeable figures of each day and channel from one pass over the facts, with who bought.

    Whole-number ids are kept as bitmaps: a row per block of ids, with a bit for each customer of the
    block. Other ids are kept as they are, a row each. Either form counts customers exactly over any
    choice of days and channels, without going back to the facts.
    """
    rows = transactions.select(
        F.to_date("transaction_timestamp").alias("metric_date"),
        "channel",
        "customer_id",
        "is_refund_or_return",
        cents(F.col("gross_amount")).alias("amount"),
    )
    figures = [
        F.sum("amount").alias("cents"), F.count("amount").alias("priced"),
        F.count(F.lit(1)).alias("total_transactions"), F.count_if("is_refund_or_return").alias("refunds"),
    ]
    if not isinstance(transactions.schema["customer_id"].dataType, IntegralType):
        return rows.groupBy("metric_date", "channel", "customer_id").agg(*figures)
    block = F.bitmap_bucket_number("customer_id").alias("block")
    buyers = F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("buyers")
    return rows.groupBy("metric_date", "channel", block).agg(*figures, buyers)


def kpis_from_partials(partials: DataFrame) -> DataFrame:
    """What executive_kpis gives, from the stored partial figures."""
    counted = F.sum(F.bitmap_count("buyers")) if "buyers" in partials.columns else F.count("customer_id")
    merged = partials.groupBy("metric_date", "channel").agg(
        *[F.sum(name).alias(name) for name in ("cents", "priced", "total_transactions", "refunds")],
        counted.alias("unique_customers"),
    )
    return merged.select(
        "metric_date",
        "channel",
        from_cents(F.col("cents")).alias("total_revenue"),
        "total_transactions",
        "unique_customers",
        guarded_ratio(from_cents(F.col("cents")), F.col("priced")).alias("avg_order_value"),
        guarded_ratio(F.col("refunds"), F.col("total_transactions")).alias("refund_return_rate"),
    )


def distinct_customers(partials: DataFrame, *by: str) -> DataFrame:
    """Customers counted once, over all the partials or for each value of some of their columns."""
    if "buyers" not in partials.columns:
        return partials.groupBy(*by).agg(F.count_distinct("customer_id").alias("distinct_customers"))
    blocks = partials.groupBy(*by, "block").agg(F.bitmap_count(F.bitmap_or_agg("buyers")).alias("n"))
    return blocks.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("distinct_customers"))


def channel_summary(kpis: DataFrame) -> DataFrame:
    """Per channel: plain averages of the daily figures, and the volume-weighted ones."""
    total = F.sum(cents(F.col("total_revenue")))
    volume = F.sum("total_transactions")
    refunds = F.sum(F.round(F.col("refund_return_rate") * F.col("total_transactions")).cast("long"))
    return (
        kpis.groupBy("channel")
        .agg(
            F.count_distinct("metric_date").alias("date_count"),
            from_cents(total).alias("total_revenue"),
            volume.alias("total_transactions"),
            F.avg("avg_order_value").alias("avg_order_value"),
            F.avg("refund_return_rate").alias("avg_refund_rate"),
            (from_cents(total) / volume).alias("weighted_order_value"),
            (refunds / volume).alias("weighted_refund_rate"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def overall(kpis: DataFrame, partials: DataFrame) -> DataFrame:
    """Whole-business totals. customer_days adds up daily distinct counts and so
    counts a customer once per day and channel; distinct_customers, merged from the
    stored bitmaps, does not."""
    distinct = distinct_customers(partials)
    return kpis.agg(
        from_cents(F.sum(cents(F.col("total_revenue")))).alias("total_business_revenue"),
        F.sum("total_transactions").alias("total_business_transactions"),
        F.count_distinct("metric_date").alias("days_of_data"),
        F.sum("unique_customers").alias("customer_days"),
    ).select("*", distinct.scalar().alias("distinct_customers"))


def latest(kpis: DataFrame, n: int = 10) -> DataFrame:
    return kpis.orderBy(F.desc("metric_date"), "channel").limit(n)


def completed_revenue(orders: DataFrame, pos: DataFrame) -> DataFrame:
    """Completed revenue per source."""

    def total(df: DataFrame, source: str, status: str, amount: str) -> DataFrame:
        return (
            df.filter(F.col(status) == fixed.COMPLETED)
            .agg(F.coalesce(F.sum(cents(F.col(amount))), F.lit(0)).alias("cents"))
            .select(F.lit(source).alias("source"), from_cents(F.col("cents")).alias("completed_revenue"))
        )

    return total(orders, "ecommerce", "order_status", "order_amount").unionByName(
        total(pos, "pos", "transaction_status", "transaction_amount")
    )
