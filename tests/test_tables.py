"""The tables over a user's own source frames, here generated ones with text keys."""

import pytest
from retail_helpers import rows
from pyspark.sql import functions as F

from keepwell.plans import kpis
from keepwell.plans.medallion import refresh_gold
from keepwell.plans.tables import CustomerTables
from keepwell.sources import generate
from keepwell.sources.bronze import BronzeFrames
from keepwell.sources.tables import create_database, publish

DAY = "2001-08-01"
CUSTOMERS, PRODUCTS, SALES = 400, 40, 3000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    as_of = F.to_date(F.lit(DAY))
    base = str(tmp_path_factory.mktemp("bronze"))
    create_database(spark, "shop")
    frames = {
        "products": generate.products(spark.range(1, PRODUCTS + 1)),
        "customers": generate.customers(spark.range(1, CUSTOMERS + 1), as_of),
        "loyalty_profiles": generate.loyalty(spark.range(1, CUSTOMERS + 1), as_of, CUSTOMERS),
        "ecommerce_orders": generate.orders(spark.range(1, SALES + 1), as_of, CUSTOMERS, PRODUCTS),
        "pos_transactions": generate.pos(spark.range(1, SALES + 1), as_of, CUSTOMERS, PRODUCTS),
    }
    for name, df in frames.items():
        publish(df, f"shop.bronze_{name}", base)
    return CustomerTables(spark, BronzeFrames.from_tables(spark, "shop", DAY))


def test_every_customer_has_profile_score_and_action(tables):
    for frame in (tables.c360_n, tables.c360_p, tables.scores_n, tables.scores_p, tables.actions_n, tables.actions_p):
        counted = frame.agg(F.count("customer_id"), F.count_distinct("customer_id")).first()
        assert tuple(counted) == (CUSTOMERS, CUSTOMERS)


def test_revenue_of_the_profiles_is_revenue_of_known_buyers(tables):
    cents = F.sum(F.round(F.col("gross_amount") * 100).cast("long"))
    known = tables.transactions.filter("customer_id IS NOT NULL")
    whole = tables.c360_n.agg(F.sum(F.round(F.col("total_revenue") * 100).cast("long"))).first()[0]
    assert whole == known.agg(cents).first()[0]
    completed = tables.c360_p.agg(F.sum(F.round(F.col("total_revenue") * 100).cast("long"))).first()[0]
    assert completed == known.filter("is_completed_transaction").agg(cents).first()[0]


def test_the_day_moves_recency_and_drops_no_row(spark, tables):
    earlier = CustomerTables(spark, BronzeFrames.from_tables(spark, "shop", "2000-08-01"))
    assert earlier.transactions.count() == tables.transactions.count()
    assert earlier.customers_n.count() == CUSTOMERS
    for state, day in ((earlier, "2000-08-01"), (tables, DAY)):
        # the last purchase up to the day counts; without one the customer has never purchased yet
        bought = F.to_date("transaction_timestamp")
        age = F.datediff(F.lit(day).cast("date"), bought)
        last = state.transactions.filter(age >= 0).groupBy("customer_id").agg(F.min(age).alias("age"))
        expected = state.customers_n.join(last, "customer_id", "left").select("customer_id", F.coalesce("age", F.lit(9999)))
        assert rows(state.c360_n, "customer_id", "days_since_last_purchase") == rows(expected)


def test_stored_gold_equals_the_frames(spark, tables, tmp_path):
    gold = refresh_gold(spark, "shop_gold", str(tmp_path), tables.profile_n, tables.kpis, "N")
    assert rows(gold["gold_next_best_actions"]) == rows(tables.actions_n)
    assert rows(gold["gold_executive_kpis"]) == rows(tables.kpis)


@pytest.mark.parametrize("text_ids", [False, True])
def test_buyers_are_counted_without_the_facts(spark, env, tables, tmp_path, text_ids):
    """From the stored partials of each day: daily, monthly and overall counts, for whole-number and for text ids."""
    facts = (tables if text_ids else env).transactions
    partials = kpis.daily_partials(facts)
    assert ("buyers" in partials.columns) != text_ids
    gold = refresh_gold(spark, f"bits_{text_ids}".lower(), str(tmp_path), env.profile_n, None, "N", partials)
    assert rows(gold["gold_executive_kpis"]) == rows(kpis.executive_kpis(facts))
    whole = kpis.overall(gold["gold_executive_kpis"], gold["gold_daily_partials"])
    assert whole.first().distinct_customers == facts.select("customer_id").dropna().distinct().count()
    assert all("snapshot-" in path for path in whole.inputFiles())
    by_channel = kpis.distinct_customers(gold["gold_daily_partials"], "channel")
    assert rows(by_channel) == rows(facts.groupBy("channel").agg(F.count_distinct("customer_id").alias("n")))


def test_odd_ids_in_bitmaps(spark):
    ids = [None, 0, 1, -1, 32768, 32769, 2**40, -(2**40), 1]
    facts = spark.createDataFrame([(i,) for i in ids], "customer_id long").selectExpr(
        "customer_id", "timestamp_ntz'2020-01-01 10:00:00' AS transaction_timestamp", "'x' AS channel",
        "1.5D AS gross_amount", "false AS is_refund_or_return",
    )
    partials = kpis.daily_partials(facts)
    assert kpis.distinct_customers(partials).first()[0] == 7
    assert rows(kpis.kpis_from_partials(partials)) == rows(kpis.executive_kpis(facts))
    assert kpis.distinct_customers(partials.limit(0)).first()[0] == 0
