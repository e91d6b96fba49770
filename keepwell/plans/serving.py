"""Lookup and dashboard queries over the gold tables. Values typed by a user stay values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.plans.churn import top_risk


def risk_distribution(scores: DataFrame) -> DataFrame:
    """Every band with count and share, bands without customers included, from one pass."""
    counted = scores.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *[F.count_if(F.col("churn_risk_band") == band).alias(band) for band in fixed.RISK_BANDS],
    )
    whole = F.col("total_customers")
    bands = F.array(
        *[
            F.struct(
                F.lit(band).alias("churn_risk_band"),
                F.col(band).alias("customer_count"),
                F.when(whole > 0, F.col(band) * 100.0 / whole).otherwise(0.0).alias("pct"),
            )
            for band in fixed.RISK_BANDS
        ]
    )
    return counted.select("total_customers", F.inline(bands))


def loyalty_distribution(c360: DataFrame) -> DataFrame:
    """Customers per tier with their share of all customers.

    The share divides by the sum over the handful of tier rows, not by a second scan.
    """
    counted = c360.groupBy(F.coalesce("loyalty_tier", F.lit(fixed.NON_MEMBER)).alias("tier")).agg(
        F.count(F.lit(1)).alias("customer_count")
    )
    whole = counted.agg(F.sum("customer_count")).scalar()
    return counted.withColumn("pct", F.col("customer_count") * 100.0 / whole).orderBy(
        F.desc("customer_count"), "tier"
    )


def top_high_risk(scores: DataFrame, n: int = 10) -> DataFrame:
    return top_risk(scores, n, "High").select(
        "customer_id", "churn_score", "top_reason_1", "top_reason_2", "recommended_action"
    )


def customer_search(scores: DataFrame, c360: DataFrame, text: str, n: int = 20) -> DataFrame:
    """Customers whose id contains the text, ignoring case; a blank text finds nobody.

    Only the n hits meet the profile table.
    """
    wanted = text.strip().lower()
    matches = F.lower(F.col("customer_id").cast("string")).contains(F.lit(wanted)) if wanted else F.lit(False)
    hits = (
        scores.filter(matches)
        .select("customer_id", "churn_risk_band", "churn_score", "top_reason_1")
        .orderBy("customer_id")
        .limit(n)
    )
    return hits.join(c360.select("customer_id", "full_name"), "customer_id", "left").select(
        "customer_id", "full_name", "churn_risk_band", "churn_score", "top_reason_1"
    )


def customer_detail(scores: DataFrame, c360: DataFrame, actions: DataFrame, customer_id: object) -> DataFrame:
    """One customer's score, profile and summary; no row for an unknown id.

    The id filter reaches each of the three scans.
    """

    def of_customer(df: DataFrame, *columns: str) -> DataFrame:
        return df.filter(F.col("customer_id") == F.lit(customer_id)).select("customer_id", *columns)

    profile = of_customer(
        c360, "full_name", "loyalty_tier", "total_revenue", "total_transactions",
        "days_since_last_purchase", "preferred_channel",
    )
    return (
        of_customer(scores, "churn_score", "churn_risk_band", "top_reason_1", "top_reason_2")
        .join(profile, "customer_id", "left")
        .join(of_customer(actions, "customer_summary"), "customer_id", "left")
    )


def nba_sample(actions: DataFrame, n: int = 5) -> DataFrame:
    return actions.select("customer_id", "customer_summary").orderBy("customer_id").limit(n)
