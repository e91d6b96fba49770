"""One customer, product or line holding a third of all rows changes nothing but the speed."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from retail_helpers import rows
from pyspark.sql import functions as F

from keepwell.operators import dedup, ranking
from keepwell.plans import customer360, kpis

DAY = dt.date(2001, 8, 1)
N = 30_000


@pytest.fixture(scope="module")
def facts(spark):
    i = F.col("id")
    return spark.range(N).select(
        i.cast("string").alias("transaction_id"),
        F.when(i % 3 == 0, 1).when(i % 3 == 1, i % 500 + 2).alias("customer_id"),  # a third hot, a third unknown
        F.when(i % 3 != 2, 7).otherwise(i % 40).alias("product_id"),
        F.date_sub(F.lit(DAY), (i % 200).cast("int")).cast("timestamp_ntz").alias("transaction_timestamp"),
        (i % 1000 / 100.0 + 1).alias("gross_amount"),
        F.when(i % 5 == 0, "In-Store").otherwise("Ecommerce").alias("channel"),
        (i % 7 != 0).alias("is_completed_transaction"),
        (i % 7 == 0).alias("is_refund_or_return"),
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.range(40).select(
        F.col("id").alias("product_id"), F.concat(F.lit("cat"), (F.col("id") % 6).cast("string")).alias("category")
    )


def by_hand(facts, products):
    category = {r.product_id: r.category for r in products.collect()}
    groups = defaultdict(list)
    for r in facts.collect():
        if r.customer_id is not None:
            groups[r.customer_id].append(r)

    def top(values):
        counts = Counter(values)
        return min(counts, key=lambda v: (-counts[v], v))

    out = []
    for customer, sales in groups.items():
        recent = [s for s in sales if (DAY - s.transaction_timestamp.date()).days <= 90]
        out.append(
            (
                customer,
                len(sales),
                sum(round(s.gross_amount * 100) for s in sales),
                sum(s.is_refund_or_return for s in sales),
                len(recent),
                top(s.channel for s in sales),
                top(category[s.product_id] for s in sales),
            )
        )
    return sorted(out, key=repr)


def test_rollup_with_a_hot_customer(spark, facts, products):
    columns = ("customer_id", "total_transactions", "total_cents", "refund_return_count", "transactions_last_90d",
               "preferred_channel", "favorite_category")
    expected = by_hand(facts, products)
    for parts, threshold in ((1, "-1"), (16, "10MB")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = customer360.transaction_rollup_n(facts.repartition(parts), products, F.lit(DAY))
            assert rows(got, *columns) == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_customers_leave_before_the_shuffle(facts, products):
    plan = customer360.transaction_rollup_n(facts, products, F.lit(DAY))._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange hashpartitioning(customer_id") < plan.rindex("Filter")


def test_fact_table_is_shuffled_once_for_all_measures(facts, products):
    rollup = customer360.transaction_rollup_n(facts, products, F.lit(DAY))
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(customer_id") == 1


def test_hot_line_is_pruned_to_one_row(spark):
    copies = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = dedup.keep_one(copies.repartition(8), ["k"], [F.desc("v")])
    assert kept.filter("k = 0").first().v == N - 3
    assert kept.count() == copies.select("k").distinct().count()


def places(spark):
    """Lines of 300 orders that come up to three times, orders without a key, and one order with a third of all rows."""
    i = F.col("id")
    some = spark.range(3000).select((i % 300).alias("k"), (i % 7).alias("n"), (i * 37 % 11).alias("v"))
    null = spark.range(40).select(F.lit(None).cast("long").alias("k"), F.when(i % 2 == 0, i % 3).alias("n"), i.alias("v"))
    hot = spark.range(1500).select(F.lit(7).cast("long").alias("k"), (i % 5).alias("n"), (i % 90).alias("v"))
    return some.unionByName(null).unionByName(hot)


def test_a_crowded_place_is_deduplicated_apart(spark, monkeypatch):
    df = places(spark)
    expected = rows(dedup.keep_one(df, ["k", "n"], [F.desc("v")]))
    near, apart = dedup.keep_one_at(df, ["k", "n"], [F.desc("v")], "k")
    assert rows(near) == expected and apart.count() == 0
    monkeypatch.setattr(dedup, "_CROWD_ROWS", 500)
    near, apart = dedup.keep_one_at(df, ["k", "n"], [F.desc("v")], "k")
    assert rows(near.unionByName(apart)) == expected
    assert {r.k for r in apart.collect()} == {7} and near.filter("k = 7").count() == 0
    near, apart = dedup.keep_one_at(df.limit(0), ["k", "n"], ["v"], "k")
    assert near.count() == apart.count() == 0


def test_kpis_with_a_hot_day(facts):
    hot = facts.withColumn(
        "transaction_timestamp",
        F.when(F.col("customer_id") == 1, F.lit(DAY).cast("timestamp_ntz")).otherwise(F.col("transaction_timestamp")),
    )
    got = {(r.metric_date, r.channel): r for r in kpis.executive_kpis(hot).collect()}
    groups = defaultdict(list)
    for r in hot.collect():
        groups[r.transaction_timestamp.date(), r.channel].append(r)
    assert got.keys() == groups.keys()
    for key, sales in groups.items():
        assert got[key].total_transactions == len(sales)
        assert got[key].unique_customers == len({s.customer_id for s in sales} - {None})


def test_ranks_with_one_value_in_a_third_of_the_rows(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 9999.0).otherwise(F.col("id") / 10.0).alias("v"),
        (F.col("id") % 2).cast("int").alias("y"),
    )
    values = sorted(r.v for r in df.collect())
    got = ranking.exact_quantiles(df, [], "v", {"median": 0.5}).first().median
    assert got == (values[N // 2 - 1] + values[N // 2]) / 2
    auc = ranking.rank_auc(df, "v", "y").first()
    assert auc.positives + auc.negatives == N
