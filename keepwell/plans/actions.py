"""Next best actions: texts per customer from profile and score."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.ladders import lookup
from keepwell.functions.money import cents, from_cents, money_text
from keepwell.functions.text import fill, fill_skipping_nulls

ACTIONS = (
    "customer_id", "full_name", "loyalty_tier", "total_revenue", "favorite_category", "preferred_channel",
    "churn_score", "churn_risk_band", "customer_summary", "next_best_action", "personalized_offer",
    "recommended_message",
)


def _parts(defaults: Mapping[str, str] | None = None) -> dict[str, Column]:
    columns = {
        name: F.col(name) for name in ("full_name", "loyalty_tier", "preferred_channel", "favorite_category")
    }
    for name, default in (defaults or {}).items():
        columns[name] = F.coalesce(columns[name], F.lit(default))
    columns["total_revenue"] = money_text(F.coalesce("total_revenue", F.lit(0.0)))
    columns["days_since_last_purchase"] = F.col("days_since_last_purchase").cast("string")
    return columns


def _by_band(texts: Mapping[str, Column]) -> Column:
    rest = texts[fixed.LOWEST_BAND]
    return lookup(
        F.col("churn_risk_band"), {b: text for b, text in texts.items() if b != fixed.LOWEST_BAND}, rest
    )


def add_actions_n(scored: DataFrame) -> DataFrame:
    """Variant N; a customer without a name gets no message (NULL), other gaps take defaults."""

    def texts(templates: Mapping[str, str], defaults: Mapping[str, Mapping[str, str]]) -> dict[str, Column]:
        return {band: fill(text, _parts(defaults[band])) for band, text in templates.items()}

    offers = texts(fixed.OFFER_N, fixed.OFFER_DEFAULTS_N)
    better = fill(fixed.OFFER_TOP_TIER_N, _parts(fixed.OFFER_DEFAULTS_N["High"]))
    offers["High"] = F.when(F.col("loyalty_tier").isin(*fixed.TOP_TIERS), better).otherwise(offers["High"])
    return scored.withColumns(
        {
            "customer_summary": fill(fixed.SUMMARY_N, _parts(fixed.SUMMARY_DEFAULTS_N)),
            "next_best_action": _by_band(texts(fixed.NEXT_ACTION_N, fixed.NEXT_ACTION_DEFAULTS_N)),
            "personalized_offer": _by_band(offers),
            "recommended_message": _by_band(texts(fixed.MESSAGE_N, fixed.MESSAGE_DEFAULTS_N)),
        }
    )


def add_actions_p(scored: DataFrame) -> DataFrame:
    """Variant P; missing parts are left out of the texts."""
    parts = _parts()
    with_default = {
        **parts,
        "favorite_category": F.coalesce(parts["favorite_category"], F.lit(fixed.OFFER_DEFAULT_CATEGORY_P)),
    }
    return scored.withColumns(
        {
            "customer_summary": fill_skipping_nulls(fixed.SUMMARY_P, parts),
            "next_best_action": _by_band({b: F.lit(t) for b, t in fixed.NEXT_ACTION_P.items()}),
            "personalized_offer": _by_band({b: fill(t, with_default) for b, t in fixed.OFFER_P.items()}),
            "recommended_message": _by_band(
                {b: fill_skipping_nulls(t, parts) for b, t in fixed.MESSAGE_P.items()}
            ),
        }
    )


def _joined(c360: DataFrame, scores: DataFrame) -> DataFrame:
    return c360.join(scores.select("customer_id", "churn_score", "churn_risk_band"), "customer_id")


def next_best_actions_n(c360: DataFrame, scores: DataFrame) -> DataFrame:
    """From two stored gold tables; over one profile, use add_actions_n without a join."""
    return add_actions_n(_joined(c360, scores)).select(*ACTIONS)


def next_best_actions_p(c360: DataFrame, scores: DataFrame) -> DataFrame:
    return add_actions_p(_joined(c360, scores)).select(*ACTIONS)


def campaign_volume(actions: DataFrame) -> DataFrame:
    return (
        actions.groupBy("churn_risk_band", "loyalty_tier")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            (from_cents(F.sum(cents(F.col("total_revenue")))) / F.count("total_revenue")).alias("avg_revenue"),
        )
        .orderBy("churn_risk_band", "loyalty_tier")
    )


def high_risk_sample(actions: DataFrame, n: int = 5) -> DataFrame:
    return (
        actions.filter(F.col("churn_risk_band") == "High")
        .select(
            "customer_id", "full_name", "churn_risk_band", "customer_summary", "personalized_offer",
            "recommended_message",
        )
        .orderBy("customer_id")
        .limit(n)
    )
