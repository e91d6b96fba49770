"""Operators against small hand-made or brute-forced expectations."""

import datetime as dt
import random

import numpy as np
import pytest
from retail_helpers import rows
from pyspark.sql import functions as F

from keepwell.functions.draws import uniform
from keepwell.operators import dedup, mlprep, quality, ranking, sync
from keepwell.plans import customer360, kpis, serving, silver
from keepwell.sources import generate
from keepwell.sources.tables import create_database, manifest, publish

DAY = dt.date(2001, 8, 1)


# --- dedup -------------------------------------------------------------------------
def test_latest_customer_wins_and_ties_are_broken(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), "b"), (1, dt.date(2001, 1, 1), "z"), (1, dt.date(2001, 1, 1), "y"), (2, None, "n")],
        "customer_id long, registration_date date, phone string",
    )
    for parts in (1, 5):
        assert rows(dedup.latest_customers(df.repartition(parts)), "customer_id", "phone") == [(1, "y"), (2, "n")]


def test_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "k long, v long")
    assert dedup.keep_one(empty, ["k"], ["v"]).count() == 0


def test_dedup_prunes_before_the_shuffle(spark):
    df = dedup.keep_one(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Partial") > plan.index("Exchange")


# --- quality --------------------------------------------------------------------------
def test_rules_count_drop_and_quarantine(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), (None, 1.0, 1), ("c", -1.0, 0), ("d", None, 1)], "order_id string, order_amount double, quantity long"
    )
    assert quality.drop_violators(df, quality.ORDER_RULES).count() == 3
    got = rows(quality.report(df, quality.ORDER_RULES, "orders"), "rule", "action", "rows_checked", "violations")
    assert got == [("valid_amount", "keep", 4, 2), ("valid_order_id", "drop", 4, 1), ("valid_quantity", "keep", 4, 1)]
    held = quality.quarantine(df, quality.ORDER_RULES)
    assert rows(held.select("order_id", F.concat_ws("+", "violations").alias("v"))) == [
        ("c", "valid_amount+valid_quantity"), ("d", "valid_amount"), (None, "valid_order_id"),
    ]


def test_observed_metrics_come_with_the_consuming_job(spark):
    df = spark.createDataFrame([(None, "x@y"), (1, "nope"), (2, None)], "customer_id long, email string")
    kept, watch = quality.observed(df, quality.CUSTOMER_RULES, "customers")
    assert kept.count() == 2
    assert watch.get == {"rows": 3, "valid_customer_id": 1, "valid_email": 2}


def test_unknown_tier_and_negative_points(spark):
    df = spark.createDataFrame(
        [(1, "Diamond", -5, DAY, " active"), (2, " gold ", None, DAY, "active")],
        "customer_id long, loyalty_tier string, points_balance long, member_since date, status string",
    )
    assert rows(silver.loyalty_n(df), "customer_id", "loyalty_tier", "points_balance", "status") == [
        (1, "Diamond", 0, "Active"), (2, "Gold", None, "Active"),
    ]
    assert rows(quality.report(df, quality.LOYALTY_RULES, "l"), "rule", "violations")[1] == ("valid_tier", 2)


def test_products_without_price_go_only_in_one_variant(spark):
    df = spark.createDataFrame(
        [(1, " a ", "TOYS", "GlobalTech", 0.0), (2, "b", "x", "y", None), (3, "c", "x", "PlayZone", 2.0)],
        "product_id long, product_name string, category string, brand string, price double",
    )
    assert rows(silver.products_n(df), "product_id", "brand") == [(3, "Playzone")]
    assert rows(silver.products_n(df, title_brand=False), "product_id", "brand") == [(3, "PlayZone")]
    assert silver.silver_p("products", df).count() == 3


# --- conform --------------------------------------------------------------------------
def order_rows(spark, data):
    return spark.createDataFrame(
        data,
        "order_id string, customer_id long, product_id long, order_date timestamp_ntz, quantity long, "
        "order_amount double, order_status string, channel string, payment_method string",
    )


def pos_rows(spark, data):
    return spark.createDataFrame(
        data,
        "transaction_id string, customer_id long, product_id long, transaction_date timestamp_ntz, quantity long, "
        "transaction_amount double, transaction_status string, channel string, store_id string, store_name string, "
        "store_city string, store_state string, payment_method string",
    )


def at(day):
    return dt.datetime.combine(DAY - dt.timedelta(days=day), dt.time())


def sale(name, customer, age, status="Completed", amount=10.0, product=1, quantity=1):
    return (name, customer, product, at(age), quantity, amount, status, "Ecommerce", "Card")


def store_sale(name, customer, age, status="Completed", amount=10.0, product=1):
    return (name, customer, product, at(age), 1, amount, status, "In-Store", "S", "n", "c", "s", "Cash")


def test_unified_filters_flags_and_columns(spark):
    orders = order_rows(
        spark,
        [sale("1", 1, 5), sale("2", None, 5, "Returned"), sale("3", 1, 5, quantity=0), sale("4", 1, 5, amount=0.0),
         sale("5", 1, 5, product=None), sale("6", 1, 5, None)],
    )
    pos = pos_rows(spark, [store_sale("7", 2, 1, "Cancelled")])
    unified = silver.transactions_unified(orders, pos)
    assert len(unified.columns) == 17
    flags = ["transaction_id", "store_id", "is_completed_transaction", "is_refund_or_return", "is_customer_identified"]
    assert rows(unified, *flags) == [
        ("1", None, True, False, True), ("2", None, False, True, False),
        ("6", None, False, False, True), ("7", "S", False, True, True),
    ]


# --- customer 360 -------------------------------------------------------------------------
@pytest.fixture
def shop(spark):
    orders = order_rows(
        spark,
        [sale("1", 1, 30, amount=10.10), sale("2", 1, 31, amount=20.20, product=2), sale("3", 1, 90, "Returned"),
         sale("4", 1, 91, product=2), sale("5", None, 1), sale("6", 3, 10, "Cancelled")],
    )
    pos = pos_rows(spark, [store_sale("7", 1, 0, product=1), store_sale("8", 2, 200, "Refunded"), store_sale("9", None, 1)])
    products = spark.createDataFrame([(1, "Toys"), (2, "Beauty")], "product_id long, category string")
    return orders, pos, products


def test_rollup_n(spark, shop):
    orders, pos, products = shop
    unified = silver.transactions_unified(orders, pos)
    got = customer360.transaction_rollup_n(unified, products, F.lit(DAY))
    row = got.filter("customer_id = 1").first()
    assert (row.total_transactions, row.completed_transactions, row.refund_return_count) == (5, 4, 1)
    assert row.total_cents == 1010 + 2020 + 3000
    assert (row.transactions_last_30d, row.transactions_last_90d) == (2, 4)
    assert (row.preferred_channel, row.favorite_category) == ("Ecommerce", "Toys")
    assert {r.customer_id for r in got.collect()} == {1, 2, 3}


def test_rollup_p_counts_completed_only_and_breaks_ties_low(spark, shop):
    orders, pos, products = shop
    got = customer360.transaction_rollup_p(orders, pos, products, F.lit(DAY))
    row = got.filter("customer_id = 1").first()
    assert (row.ecom_orders, row.pos_orders, row.refund_return_count) == (3, 1, 1)
    assert (row.transactions_last_30d, row.transactions_last_90d) == (2, 3)
    assert (row.first_purchase_date, row.last_purchase_date) == (at(91), at(30))
    assert row.favorite_category == "Beauty"
    # customer 3 cancelled and customer 2 was refunded in the store: neither is counted in this variant
    assert {r.customer_id for r in got.collect()} == {1}
    tied = order_rows(spark, [sale("1", 1, 1, product=1), sale("2", 1, 1, product=2)])
    assert customer360.transaction_rollup_p(tied, pos, products, F.lit(DAY)).filter("customer_id=1").first().favorite_category == "Beauty"


def test_preferences_agree_with_count_and_rank(spark, shop):
    orders, pos, products = shop
    fused = customer360.transaction_rollup_p(orders, pos, products, F.lit(DAY)).filter("ecom_orders > 0")
    assert rows(fused, "customer_id", "favorite_category") == rows(customer360.favorite_category_p(orders, products))
    assert rows(fused, "customer_id", "preferred_channel") == rows(customer360.preferred_channel_p(orders))


def test_kpis_reconcile(spark, shop):
    orders, pos, _ = shop
    unified = silver.transactions_unified(orders, pos)
    daily = kpis.executive_kpis(unified)
    total = unified.agg(F.sum("gross_amount")).first()[0]
    row = kpis.overall(daily, unified).first()
    assert row.total_business_revenue == pytest.approx(total)
    assert (row.total_business_transactions, row.distinct_customers) == (9, 3)


# --- ranking ---------------------------------------------------------------------------------
VALUES = [-(10.0**9), -3.5, -3.5, -1e-9, 0.0, 0.0, 1e-12, 0.5, 0.5000001, 1.0, 2.0, 2.0, 3.0, 1023.99, 1024.0, 9999.0, 1e15]


def test_order_key_never_decreases(spark):
    random.seed(5)
    near = [m * 2.0**e for e in (-40, -1, 0, 1, 29, 31, 64) for m in (1 - 2**-53, 1.0, 1 + 2**-52, 1 + 2**-51, 1.3)]
    many = [random.choice([-1, 1]) * random.random() * 10.0 ** random.randint(-12, 12) for _ in range(3000)]
    limits = [float("inf"), float("-inf"), float("nan"), 1e300, -1e300, 1e279]
    df = spark.createDataFrame([(v,) for v in VALUES + near + many + limits], "v double")
    for column in [ranking.order_key(F.col("v")), *ranking.value_prefixes(F.col("v"))]:
        ordered = [r.k for r in df.orderBy("v").select(column.alias("k")).collect()]
        assert ordered == sorted(ordered)


def test_close_values_are_spread_over_many_buckets(spark):
    """Scores crowded into a ten-thousandth still fall into small finest buckets."""
    df = spark.range(20000).select((F.lit(0.5) + F.col("id") * 5e-9).alias("v"))
    finest = ranking.value_prefixes(F.col("v"))[-1]
    largest = df.groupBy(finest.alias("b")).count().agg(F.max("count")).first()[0]
    assert largest < 10
    got = ranking.exact_quantiles(df, [], "v", {"q": 0.75}).first().q
    assert got == pytest.approx(np.quantile([r.v for r in df.collect()], 0.75), rel=1e-15)


def test_quantiles_equal_numpy(spark):
    random.seed(7)
    data = [("a", v) for v in VALUES] + [("b", random.uniform(-50, 50)) for _ in range(997)] + [("b", 1.0)] * 500
    data += [("a", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    shares = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1.0}
    got = {r.g: r for r in ranking.exact_quantiles(df, ["g"], "v", shares).collect()}
    for group in "ab":
        values = [v for g, v in data if g == group and v is not None]
        for name, share in shares.items():
            assert got[group][name] == pytest.approx(np.quantile(values, share), rel=1e-12)


def test_split_is_exact_and_independent_of_partitions(spark):
    df = spark.range(1000).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") < 300, 1).when(F.col("id") < 990, 0).alias("label")
    )
    shares = (("train", 0.70), ("validation", 0.15), ("test", 0.15))
    first = ranking.stratified_split(df, "label", "customer_id", shares, 42)
    second = ranking.stratified_split(df.repartition(9), "label", "customer_id", shares, 42)
    assert rows(first, "customer_id", "split") == rows(second, "customer_id", "split")
    sizes = {(r.label, r.split): r["count"] for r in first.groupBy("label", "split").count().collect()}
    assert (sizes[1, "train"], sizes[1, "validation"], sizes[1, "test"]) == (210, 45, 45)
    assert first.count() == 1000  # rows without a label stay


def test_auc_equals_pair_counting(spark):
    random.seed(3)
    data = [(random.randint(0, 1), round(random.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(data, "label int, score double")
    positives = [s for y, s in data if y == 1]
    negatives = [s for y, s in data if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert ranking.rank_auc(df, "score", "label").first().roc_auc == pytest.approx(wins / len(positives) / len(negatives))


# --- feature preparation ---------------------------------------------------------------------
def test_impute_and_scale_use_training_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (10.0,)], "x double")
    assert mlprep.fitted_medians(df, ["x"]) == {"x": 3.0}
    filled = mlprep.impute(df, {"x": 3.0})
    mean, dev = mlprep.fitted_scales(filled, ["x"])["x"]
    assert (mean, dev) == (pytest.approx(4.25), pytest.approx(np.std([1, 3, 3, 10])))
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert rows(mlprep.scale(constant, mlprep.fitted_scales(constant, ["x"]))) == [(0.0,), (0.0,)]


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id long, tier string")
    levels = mlprep.category_levels(df, ["tier"])
    assert levels == {"tier": ["a", "b", "c"]}
    encoded = mlprep.one_hot(df, levels)
    assert encoded.columns == ["id", "tier_b", "tier_c"]
    assert rows(encoded) == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]


def test_columns_with_many_levels_encode(spark):
    df = spark.range(3000).select("id", F.format_string("L%04d", "id").alias("c"))
    assert len(mlprep.category_levels(df, ["c"])["c"]) == 3000
    encoded = mlprep.one_hot_rows(df, "id", ["c"])
    assert encoded.count() == 2999  # the first level is left out
    assert rows(encoded.filter("id in (0, 1, 2999)")) == [(1, "c", "L0001"), (2999, "c", "L2999")]


# --- sync -----------------------------------------------------------------------------------------
def versions(spark):
    schema = "customer_id long, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e")], schema)
    return old, new


def test_added_column_is_a_change_and_is_kept(spark):
    old, new = versions(spark)
    wider = old.withColumn("w", F.when(F.col("customer_id") == 1, 7))
    feed = sync.snapshot_diff(old, wider, "customer_id")
    assert feed.columns == ["customer_id", "v", "w", "_change_type"]
    assert rows(feed) == [(1, "a", 7, "update_postimage"), (1, "a", None, "update_preimage")]
    assert rows(sync.upsert_merge(old, feed, "customer_id")) == rows(wider)
    assert not sync.sync_check(wider, old, "customer_id", "t").first()["in_sync"]


def test_diff_has_every_kind_of_change(spark):
    old, new = versions(spark)
    assert rows(sync.snapshot_diff(old, new, "customer_id")) == [
        (2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "delete"), (5, "e", "insert"),
    ]


def test_merge_is_idempotent_and_leaves_no_difference(spark):
    old, new = versions(spark)
    feed = sync.snapshot_diff(old, new, "customer_id")
    once = sync.upsert_merge(old, feed, "customer_id")
    assert rows(once) == rows(new)
    assert rows(sync.upsert_merge(once, feed, "customer_id")) == rows(new)
    assert sync.snapshot_diff(once, new, "customer_id").count() == 0
    assert sync.sync_check(new, once, "customer_id", "t").first().in_sync
    stale = sync.sync_check(new, old, "customer_id", "t").first()
    assert (stale.missing_rows, stale.extra_rows, stale.different_rows, stale.in_sync) == (1, 1, 1, False)


def test_publish_replaces_reads_itself_and_changes_schema(spark, tmp_path):
    create_database(spark, "published", "it's a test")
    base = str(tmp_path)
    first = publish(spark.range(10).withColumn("v", F.lit(1)), "published.t", base, "first", bucket_key="id")
    second = publish(first.filter("id < 3").select("id"), "published.t", base, "it's new")
    assert (second.columns, second.count()) == (["id"], 3)
    assert spark.table("published.t").count() == 3
    row = manifest(spark, "published", ["t"]).first()
    assert (row.comment, row.column_count, row.row_count) == ("it's new", 1, 3)
    assert sync.matching_tables(spark, ["T"], "published") == ["t"]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    create_database(spark, "bucketed")
    a = publish(spark.range(50).withColumn("v", F.lit(1)), "bucketed.a", str(tmp_path), bucket_key="id")
    b = publish(spark.range(60).withColumn("v", F.lit(1)), "bucketed.b", str(tmp_path), bucket_key="id")
    diff = sync.snapshot_diff(a, b, "id")
    assert "Exchange" not in diff._jdf.queryExecution().executedPlan().toString()
    assert diff.count() == 10


def test_describe_counts_missing_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert rows(sync.describe(df, "t"), "column_name", "data_type", "null_values") == [("a", "bigint", 0), ("b", "string", 1)]


# --- serving -------------------------------------------------------------------------------------
def test_search_and_detail(spark):
    scores = spark.createDataFrame(
        [("CUST12", "High", 70, "r1", "r2", "a"), ("cust112", "Low", 1, "r1", "r2", "a"), ("X_%", "Low", 2, "r1", "r2", "a")],
        "customer_id string, churn_risk_band string, churn_score int, top_reason_1 string, top_reason_2 string, recommended_action string",
    )
    c360 = spark.createDataFrame([("CUST12", "Ann")], "customer_id string, full_name string")
    assert rows(serving.customer_search(scores, c360, " ust1 "), "customer_id", "full_name") == [("CUST12", "Ann"), ("cust112", None)]
    assert serving.customer_search(scores, c360, "   ").count() == 0
    assert rows(serving.customer_search(scores, c360, "%"), "customer_id") == [("X_%",)]
    assert serving.customer_search(scores, c360, "' OR 1=1 --").count() == 0
    assert rows(serving.risk_distribution(scores), "churn_risk_band", "customer_count") == [("High", 1), ("Low", 2), ("Medium", 0)]


def test_unknown_customer_has_no_detail(spark, env):
    from keepwell.queries import gold

    tables = gold(env)
    args = (tables["gold_customer_churn_scores"], tables["gold_customer_360"], tables["gold_next_best_actions"])
    assert serving.customer_detail(*args, -1).count() == 0
    assert serving.customer_detail(*args, 7).count() == 1


# --- generated rows ----------------------------------------------------------------------------------
def test_generated_rows_do_not_depend_on_partitions(spark):
    as_of = F.lit(DAY)
    for make in (
        lambda ids: generate.products(ids),
        lambda ids: generate.customers(ids, as_of),
        lambda ids: generate.loyalty(ids, as_of, 500),
        lambda ids: generate.orders(ids, as_of, 500, 50),
        lambda ids: generate.pos(ids, as_of, 500, 50),
    ):
        assert rows(make(spark.range(1, 501, 1, 1))) == rows(make(spark.range(1, 501, 1, 7)))


def test_generated_shares(spark):
    as_of, ids = F.lit(DAY), spark.range(1, 5001)
    assert generate.loyalty(ids, as_of, 5000).count() == 3500
    orders = generate.orders(ids, as_of, 1000, 50)
    busy = orders.filter(F.substring("customer_id", 5, 6).cast("int") <= 200).count() / 5000
    assert abs(busy - 0.8) < 0.02
    pos = generate.pos(ids, as_of, 1000, 50)
    assert abs(pos.filter("customer_id IS NULL").count() / 5000 - 0.4) < 0.03
    draw = spark.range(10000).agg(F.avg(uniform(F.col("id"), "x")), F.min(uniform(F.col("id"), "x"))).first()
    assert abs(draw[0] - 0.5) < 0.01 and draw[1] >= 0
