"""Churn features, labels and rule scores as projections of a customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.draws import uniform
from keepwell.functions.ladders import above, at_least, at_most, ladder, lookup
from keepwell.functions.money import guarded_ratio

FEATURES = (
    "customer_id", "loyalty_tier", "points_balance", "customer_tenure_days", "days_since_last_purchase",
    "transactions_last_30d", "transactions_last_90d", "revenue_last_30d", "revenue_last_90d",
    "avg_order_value", "preferred_channel", "refund_return_rate", "favorite_category", fixed.LABEL,
)
SCORES = ("customer_id", "churn_score", "churn_risk_band", "top_reason_1", "top_reason_2", "recommended_action")


def _refund_rate() -> Column:
    return guarded_ratio(F.col("refund_return_count"), F.col("total_transactions"))


# --- labels ---------------------------------------------------------------------
def label_n() -> Column:
    inactive = (F.col("days_since_last_purchase") > fixed.CHURN_AFTER_DAYS) | (F.col("transactions_last_90d") == 0)
    return F.when(inactive, 1).otherwise(0)


def label_p() -> Column:
    return F.when(F.col("days_since_last_purchase") > fixed.CHURN_AFTER_DAYS, 1).otherwise(0)


def noisy(label: Column, key: Column, rate: float = fixed.LABEL_NOISE_RATE, seed: int = 42) -> Column:
    """The label, flipped for a repeatable pseudo-random share of the keys."""
    return F.when(uniform(key, "label-noise", seed) < rate, 1 - label).otherwise(label)


# --- features -------------------------------------------------------------------
def add_features_n(profile: DataFrame) -> DataFrame:
    return profile.withColumns(
        {
            "customer_tenure_days": F.coalesce("customer_tenure_days", F.lit(0)),
            "refund_return_rate": _refund_rate(),
            fixed.LABEL: label_n(),
        }
    )


def add_features_p(profile: DataFrame, noise_rate: float = fixed.LABEL_NOISE_RATE, seed: int = 42) -> DataFrame:
    return profile.withColumns(
        {
            "refund_return_rate": _refund_rate(),
            fixed.LABEL: noisy(label_p(), F.col("customer_id"), noise_rate, seed),
        }
    )


def churn_features_n(profile: DataFrame) -> DataFrame:
    return add_features_n(profile).select(*FEATURES)


def churn_features_p(profile: DataFrame, noise_rate: float = fixed.LABEL_NOISE_RATE, seed: int = 42) -> DataFrame:
    return add_features_p(profile, noise_rate, seed).select(*FEATURES)


# --- score card, variant N --------------------------------------------------------
def add_score_card_n(features: DataFrame) -> DataFrame:
    parts = ("recency_score", "frequency_score", "refund_score", "loyalty_score")
    return features.withColumns(
        {
            "recency_score": above(F.col("days_since_last_purchase"), fixed.RECENCY_POINTS, 0),
            "frequency_score": at_most(F.col("transactions_last_90d"), fixed.FREQUENCY_POINTS, 0),
            "refund_score": above(F.col("refund_return_rate"), fixed.REFUND_POINTS, 0),
            "loyalty_score": lookup(F.col("loyalty_tier"), fixed.TIER_POINTS, 0),
        }
    ).withColumn("churn_score", sum((F.col(p) for p in parts[1:]), F.col(parts[0])))


def add_scores_n(features: DataFrame) -> DataFrame:
    recency, frequency, refund = F.col("recency_score"), F.col("frequency_score"), F.col("refund_score")
    recent = recency < fixed.RECENCY_NAMED_N
    return (
        add_score_card_n(features)
        .withColumns(
            {
                "churn_risk_band": at_least(F.col("churn_score"), fixed.SCORE_BANDS, fixed.LOWEST_BAND),
                "top_reason_1": ladder(
                    [
                        (recency >= fixed.RECENCY_NAMED_N, fixed.REASON_RECENCY_N),
                        (frequency >= fixed.FREQUENCY_NAMED_N, fixed.REASON_FREQUENCY_N),
                        (refund >= fixed.REFUND_NAMED_N, fixed.REASON_REFUND_N),
                    ],
                    fixed.REASON_NONE_N,
                ),
                "top_reason_2": ladder(
                    [
                        ((frequency >= fixed.SECOND_FREQUENCY_NAMED_N) & recent, fixed.SECOND_FREQUENCY_N),
                        ((refund >= fixed.REFUND_NAMED_N) & recent, fixed.SECOND_REFUND_N),
                        (F.col("loyalty_tier") == fixed.BRONZE_TIER, fixed.SECOND_TIER_N),
                    ],
                    fixed.SECOND_NONE_N,
                ),
            }
        )
        .withColumn("recommended_action", lookup(F.col("churn_risk_band"), fixed.ACTION_BY_BAND_N))
    )


def churn_scores_n(features: DataFrame) -> DataFrame:
    return add_scores_n(features).select(*SCORES)


# --- additive score, variant P ------------------------------------------------------
def add_scores_p(c360: DataFrame) -> DataFrame:
    days, revenue = F.col("days_since_last_purchase"), F.col("total_revenue")
    few = F.col("total_transactions") < fixed.FEW_TRANSACTIONS_P
    refunds = F.col("refund_return_count") > fixed.MANY_REFUNDS_P
    long_gap, gap = days > fixed.LONG_GAP_DAYS_P, days > fixed.GAP_DAYS_P
    low, least = revenue < fixed.LOW_REVENUE_P, revenue < fixed.LEAST_REVENUE_P

    def points(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    score = (
        points(long_gap, fixed.LONG_GAP_POINTS_P) + points(gap, fixed.GAP_POINTS_P)
        + points(few, fixed.FEW_TRANSACTIONS_POINTS_P) + points(low, fixed.LOW_REVENUE_POINTS_P)
        + points(refunds, fixed.MANY_REFUNDS_POINTS_P)
    )
    return c360.withColumns(
        {
            "churn_score": F.least(F.lit(fixed.MOST_POINTS_P), score).cast("int"),
            "churn_risk_band": ladder(
                [(long_gap | least, "High"), (gap | low, "Medium")],
                fixed.LOWEST_BAND,
            ),
            "top_reason_1": ladder([(long_gap, fixed.REASON_GAP_P)], fixed.REASON_NONE_P),
            "top_reason_2": ladder(
                [
                    (few, fixed.SECOND_FREQUENCY_P),
                    (low, fixed.SECOND_REVENUE_P),
                    (refunds, fixed.SECOND_REFUND_P),
                ],
                fixed.SECOND_NONE_P,
            ),
        }
    ).withColumn("recommended_action", lookup(F.col("churn_risk_band"), fixed.ACTION_BY_BAND_P))


def churn_scores_p(c360: DataFrame) -> DataFrame:
    return add_scores_p(c360).select(*SCORES)


# --- deployed model scores ------------------------------------------------------------
def add_reasons_ml(features: DataFrame) -> DataFrame:
    days = F.col("days_since_last_purchase")
    return features.withColumns(
        {
            "top_reason_1": ladder(
                [(days > fixed.LONG_GAP_DAYS_ML, fixed.REASON_GAP_ML), (days > fixed.GAP_DAYS_ML, fixed.REASON_INACTIVE_ML)],
                fixed.REASON_NONE_ML,
            ),
            "top_reason_2": ladder(
                [
                    (F.col("transactions_last_90d") < fixed.FEW_TRANSACTIONS_ML, fixed.SECOND_FREQUENCY_ML),
                    (F.col("revenue_last_90d") < fixed.LOW_REVENUE_ML, fixed.SECOND_REVENUE_ML),
                    (F.col("refund_return_rate") > fixed.HIGH_REFUND_RATE_ML, fixed.SECOND_REFUND_ML),
                ],
                fixed.SECOND_NONE_ML,
            ),
        }
    )


def scores_from_probability(features: DataFrame, probability: Column) -> DataFrame:
    """Gold score rows from a churn probability per customer."""
    return (
        add_reasons_ml(features)
        .withColumns(
            {
                "churn_score": F.bround(probability * 100, 0).cast("int"),
                "churn_risk_band": at_least(probability, fixed.PROBABILITY_BANDS, fixed.LOWEST_BAND),
            }
        )
        .withColumn("recommended_action", lookup(F.col("churn_risk_band"), fixed.ACTION_BY_BAND_P))
        .select(*SCORES)
    )


def current_scores(model_scores: DataFrame, rule_scores: DataFrame) -> DataFrame:
    """Model scores where present, rule scores otherwise; neither table overwrites the other."""
    rule = rule_scores.select("customer_id", *[F.col(name).alias(f"rule_{name}") for name in SCORES[1:]])
    joined = rule.join(model_scores, "customer_id", "full")
    scored = F.col("churn_score").isNotNull()
    return joined.select(
        "customer_id",
        *[F.when(scored, F.col(name)).otherwise(F.col(f"rule_{name}")).alias(name) for name in SCORES[1:]],
        F.when(scored, "model").otherwise("rule").alias("score_source"),
    )


# --- reports -----------------------------------------------------------------------
def label_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy(fixed.LABEL).agg(
        F.count(F.lit(1)).alias("customer_count"),
        (F.sum("days_since_last_purchase") / F.count("days_since_last_purchase")).alias("avg_days_since_last_purchase"),
        (F.sum("transactions_last_90d") / F.count("transactions_last_90d")).alias("avg_transactions_90d"),
    )


def risk_band_distribution(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("churn_risk_band")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            (F.sum("churn_score") / F.count("churn_score")).alias("avg_churn_score"),
            F.min("churn_score").alias("min_score"),
            F.max("churn_score").alias("max_score"),
        )
        .orderBy(F.desc("avg_churn_score"))
    )


def top_risk(scores: DataFrame, n: int = 10, band: str | None = None) -> DataFrame:
    chosen = scores if band is None else scores.filter(F.col("churn_risk_band") == band)
    return chosen.orderBy(F.desc("churn_score"), "customer_id").limit(n)
