"""Properties that hold on the supplied tables as a whole."""

from retail_helpers import SMALL, rows
from pyspark.sql import functions as F

from keepwell.plans import churn


def test_one_profile_row_per_customer(env):
    for frame in (env.c360_n, env.c360_p):
        counted = frame.agg(F.count("customer_id"), F.count_distinct("customer_id")).first()
        assert counted[0] == counted[1] == 150


def test_columns_of_the_gold_tables(env):
    assert len(env.c360_n.columns) == 21 and len(env.c360_p.columns) == 22
    assert env.features_n.columns == env.features_p.columns == list(churn.FEATURES)
    assert len(env.actions_n.columns) == len(env.actions_p.columns) == 12


def test_scores_stay_in_range(env):
    for frame in (env.scores_n, env.scores_p):
        low, high = frame.agg(F.min("churn_score"), F.max("churn_score")).first()
        assert 0 <= low <= high <= 100


def test_known_figures(env):
    bands = {r.churn_risk_band: r["count"] for r in env.scores_n.groupBy("churn_risk_band").count().collect()}
    assert bands == {"High": 63, "Medium": 77, "Low": 10}
    assert env.features_n.filter("days_since_last_purchase = 9999").count() == 6


def test_kpi_revenue_is_transaction_revenue(env):
    daily = env.kpis.agg(F.sum(F.round(F.col("total_revenue") * 100).cast("long"))).first()[0]
    whole = env.transactions.agg(F.sum(F.round(F.col("gross_amount") * 100).cast("long"))).first()[0]
    assert daily == whole


def test_channel_revenues_add_up(env):
    assert env.c360_n.filter("abs(total_revenue - ecommerce_revenue - instore_revenue) > 0.005").count() == 0
    assert env.c360_p.filter("abs(total_revenue - ecommerce_revenue - instore_revenue) > 0.005").count() == 0


def test_variants_agree_where_they_should(env):
    tier = F.initcap(F.trim("loyalty_tier")).alias("loyalty_tier")
    n = env.c360_n.select("customer_id", "full_name", "city", "loyalty_tier")
    p = env.c360_p.select("customer_id", "full_name", "city", tier)
    assert rows(n) == rows(p)
    tenure = ("customer_id", "customer_tenure_days")
    assert rows(env.features_n, *tenure) == rows(env.features_p, *tenure)


def test_an_earlier_day_sees_no_later_rows(env):
    earlier = env.earlier("2001-01-01")
    assert earlier.transactions.agg(F.max("transaction_timestamp")).first()[0].isoformat() <= "2001-01-01T00:00:00"
    assert earlier.customers_n.filter("customer_tenure_days < 0").count() == 0


def test_rows_after_the_day_are_no_recent_activity(env):
    assert env.transactions.filter(F.col("transaction_timestamp") > F.lit(env.inputs.as_of)).count() > 0
    for frame in (env.c360_n, env.c360_p):
        assert frame.filter("days_since_last_purchase < 0").count() == 0
    early = env.c360_n.filter(F.col("first_purchase_date") > env.as_of)
    assert early.filter("days_since_last_purchase <> 9999").count() == 0


def test_result_does_not_depend_on_shuffle_partitions(spark, env):
    from keepwell.queries import Env

    before = rows(env.actions_n)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(Env(spark, SMALL).actions_n) == before  # the same state, planned anew
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
