"""Boundaries of the score cards, bands, reasons and segments."""

import pytest
from retail_helpers import rows
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.ladders import above, at_least, at_most, ladder
from keepwell.functions.money import guarded_ratio, money_text
from keepwell.functions.text import fill, fill_skipping_nulls, mask_tail
from keepwell.operators.mlprep import binary_metrics
from keepwell.plans import actions, churn, silver


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_recency_points(spark):
    days = [0, 30, 31, 60, 61, 90, 91, 180, 181, 9999]
    got = evaluate(spark, days, "int", lambda v: above(v, fixed.RECENCY_POINTS, 0))
    assert got == [0, 0, 5, 5, 15, 15, 25, 25, 40, 40]


def test_frequency_points(spark):
    got = evaluate(spark, [0, 1, 2, 3, 4], "int", lambda v: at_most(v, fixed.FREQUENCY_POINTS, 0))
    assert got == [30, 20, 10, 10, 0]


def test_refund_points(spark):
    got = evaluate(spark, [0.15, 0.16, 0.30, 0.31], "double", lambda v: above(v, fixed.REFUND_POINTS, 0))
    assert got == [0, 10, 10, 20]


def test_bands(spark):
    got = evaluate(spark, [29, 30, 59, 60], "int", lambda v: at_least(v, fixed.SCORE_BANDS, "Low"))
    assert got == ["Low", "Medium", "Medium", "High"]
    got = evaluate(spark, [0.29, 0.3, 0.59, 0.6], "double", lambda v: at_least(v, fixed.PROBABILITY_BANDS, "Low"))
    assert got == ["Low", "Medium", "Medium", "High"]


def test_null_condition_falls_through(spark):
    assert evaluate(spark, [None], "int", lambda v: ladder([(v > 1, "a")], "b")) == ["b"]


@pytest.mark.parametrize(
    "tier, tenure, expected",
    [
        ("Platinum", 1, "VIP"),
        ("Bronze", 1, "Standard"),
        ("Non-Member", 365, "New Non-Member"),
        ("Non-Member", 366, "At-Risk Non-Member"),
        ("Non-Member", None, "Unknown"),
        ("Diamond", 5, "Unknown"),
    ],
)
def test_segments(spark, tier, tenure, expected):
    df = spark.createDataFrame([(tier, tenure)], "tier string, tenure int")
    assert df.select(silver.segment(F.col("tier"), F.col("tenure"))).first()[0] == expected


def profile(spark, **changes):
    row = {
        "customer_id": 1, "full_name": "A B", "loyalty_tier": None, "points_balance": None,
        "customer_tenure_days": None, "days_since_last_purchase": 9999, "transactions_last_30d": 0,
        "transactions_last_90d": 0, "revenue_last_30d": 0.0, "revenue_last_90d": 0.0, "avg_order_value": 0.0,
        "preferred_channel": None, "favorite_category": None, "refund_return_count": 0, "total_transactions": 0,
        "total_revenue": 0.0, **changes,
    }
    schema = (
        "customer_id long, full_name string, loyalty_tier string, points_balance long, customer_tenure_days int, "
        "days_since_last_purchase int, transactions_last_30d long, transactions_last_90d long, revenue_last_30d double, "
        "revenue_last_90d double, avg_order_value double, preferred_channel string, favorite_category string, "
        "refund_return_count long, total_transactions long, total_revenue double"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def test_never_purchased_customer(spark):
    features = churn.add_features_n(profile(spark))
    row = churn.add_scores_n(features).first()
    assert (row.customer_tenure_days, row.refund_return_rate, row.churn_label_proxy) == (0, 0.0, 1)
    assert (row.recency_score, row.frequency_score, row.loyalty_score, row.churn_score) == (40, 30, 0, 70)
    assert (row.churn_risk_band, row.top_reason_1) == ("High", fixed.REASON_RECENCY_N)
    assert churn.add_scores_p(profile(spark)).first().churn_risk_band == "High"


def test_missing_parts_of_texts(spark):
    scored = churn.add_scores_n(churn.add_features_n(profile(spark)))
    row = actions.add_actions_n(scored).first()
    assert row.customer_summary == (
        "Standard tier customer with $0.00 lifetime value. Prefers mixed channels shopping in "
        "various categories. Last purchase: 9999 days ago."
    )
    assert row.personalized_offer == "20% off + free shipping in any category"
    row = actions.add_actions_p(churn.add_scores_p(profile(spark))).first()
    assert row.customer_summary == "A B is a member with $ 0.00 in lifetime revenue."
    assert row.personalized_offer == "15% off your next store purchase"


def test_top_tier_gets_the_better_offer(spark):
    scored = churn.add_scores_n(churn.add_features_n(profile(spark, loyalty_tier="Gold", favorite_category="Toys")))
    assert actions.add_actions_n(scored).first().personalized_offer == "30% off + 2x points on next purchase in Toys"


def test_null_name_poisons_the_message_in_one_variant_only(spark):
    scored = churn.add_scores_n(churn.add_features_n(profile(spark, full_name=None)))
    assert actions.add_actions_n(scored).first().recommended_message is None
    assert actions.add_actions_p(churn.add_scores_p(profile(spark, full_name=None))).first().recommended_message


def test_additive_score(spark):
    cases = [
        (profile(spark, days_since_last_purchase=181, total_transactions=4, total_revenue=99.0, refund_return_count=4), 100, "High"),
        (profile(spark, days_since_last_purchase=91, total_transactions=5, total_revenue=500.0, refund_return_count=3), 20, "Medium"),
        (profile(spark, days_since_last_purchase=90, total_transactions=5, total_revenue=500.0, refund_return_count=3), 0, "Low"),
    ]
    for frame, score, band in cases:
        row = churn.add_scores_p(frame).first()
        assert (row.churn_score, row.churn_risk_band) == (score, band)


def test_model_score_rounds_half_to_even(spark):
    frame = churn.add_features_n(profile(spark, days_since_last_purchase=100)).withColumn("p", F.lit(0.125))
    row = churn.scores_from_probability(frame, F.col("p")).first()
    assert (row.churn_score, row.churn_risk_band, row.top_reason_1) == (12, "Low", fixed.REASON_INACTIVE_ML)


def test_noise_rate_and_repeatability(spark):
    ids = spark.range(20000)
    flipped = ids.select(churn.noisy(F.lit(0), F.col("id")).alias("v"))
    share = flipped.agg(F.avg("v")).first()[0]
    assert abs(share - fixed.LABEL_NOISE_RATE) < 0.01
    again = ids.repartition(7).select(churn.noisy(F.lit(0), F.col("id")).alias("v"))
    assert again.agg(F.avg("v")).first()[0] == share


def test_money_and_ratio(spark):
    df = spark.createDataFrame([(12345678.9, 0.0)], "a double, z double")
    assert tuple(df.select(money_text(F.col("a")), guarded_ratio(F.col("a"), F.col("z"))).first()) == ("12345678.90", 0.0)


def test_templates_and_mask(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        fill("<{a}>", {"a": a}), fill("<{b}>", {"b": b}), fill_skipping_nulls("p {b} q {a}", {"a": a, "b": b}),
        mask_tail(F.lit("+1-555-0099539")),
    ).first()
    assert tuple(row) == ("<x>", None, "p q x", "***9539")


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, said int")
    row = binary_metrics(df, "label", "said").first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_current_scores_prefer_the_model(spark):
    def score(customer, value):
        return (customer, value, "Low", "a", "b", "c")

    schema = "customer_id long, churn_score int, churn_risk_band string, top_reason_1 string, top_reason_2 string, recommended_action string"
    model = spark.createDataFrame([score(1, 7)], schema)
    rule = spark.createDataFrame([score(1, 1), score(2, 2)], schema)
    assert rows(churn.current_scores(model, rule), "customer_id", "churn_score", "score_source") == [
        (1, 7, "model"), (2, 2, "rule"),
    ]
