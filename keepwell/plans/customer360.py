"""Customer 360 in both variants.

All transaction measures of a customer - totals, recency, recent activity and
preferences - come from a single grouping on customer_id, so the fact table is
scanned once and shuffled once as partial aggregates. Rows without a customer
are removed before that shuffle: they belong to nobody and would be one hot key.
The most frequent channel and category use the deterministic mode aggregate;
its buffer holds one counter per distinct channel or category of the customer.
Catalyst prunes the measures a consumer does not select.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.money import cents, from_cents, guarded_ratio
from keepwell.functions.text import full_name
from keepwell.operators.dedup import keep_one

C360_N = (
    "customer_id", "full_name", "email", "city", "state", "loyalty_tier", "points_balance",
    "is_loyalty_member", "total_transactions", "completed_transactions", "total_revenue",
    "ecommerce_revenue", "instore_revenue", "avg_order_value", "first_purchase_date",
    "last_purchase_date", "days_since_last_purchase", "favorite_category", "preferred_channel",
    "refund_return_count", "customer_lifetime_value_proxy",
)
# What the measures of variant N and the daily figures are counted from.
FACTS = (
    "customer_id", "product_id", "transaction_timestamp", "gross_amount", "channel",
    "is_completed_transaction", "is_refund_or_return",
)
C360_P = C360_N[:3] + ("phone",) + C360_N[3:]


def _sum_cents(condition: Column, amount: Column) -> Column:
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def most_frequent(value: Column, keep_null: bool = False) -> Column:
    """Most frequent value, the lowest one on a tie. With keep_null, NULL competes too."""
    if not keep_null:
        return F.mode(value, True)
    return F.mode(value, True).getField("value")


def activity_measures(counts: Column, amount: Column, age_days: Column, windows: Sequence[int]) -> list[Column]:
    """Count and cents of the last n days up to the as-of day, for each n, inside one aggregate.

    Rows dated after the as-of day belong to the totals, but not to the recent past.
    """
    measures = []
    for days in windows:
        recent = counts & age_days.between(0, days)
        measures.append(F.count_if(recent).alias(f"transactions_last_{days}d"))
        measures.append(_sum_cents(recent, amount).alias(f"cents_last_{days}d"))
    return measures


def activity_sums(counts: Column, cents_: Column, age_days: Column, windows: Sequence[int]) -> list[Column]:
    """The same from rows that each hold a day's counts and cents."""
    measures = []
    for days in windows:
        recent = age_days.between(0, days)
        measures.append(F.coalesce(F.sum(F.when(recent, counts)), F.lit(0)).alias(f"transactions_last_{days}d"))
        measures.append(F.coalesce(F.sum(F.when(recent, cents_)), F.lit(0)).alias(f"cents_last_{days}d"))
    return measures


def _defaults(columns: dict[str, Column | int | float]) -> dict[str, Column]:
    return {name: F.coalesce(F.col(name), F.lit(value)) for name, value in columns.items()}


def _money(names: Sequence[str]) -> dict[str, Column]:
    return {
        name.replace("cents", "revenue"): from_cents(F.coalesce(F.col(name), F.lit(0))) for name in names
    }


def _recency() -> Column:
    """Days from the last purchase up to the as-of day; purchases dated after that day do not count."""
    return F.coalesce(F.col("least_age"), F.lit(fixed.NEVER_PURCHASED_DAYS))


def _least_age(counts: Column, age_days: Column) -> Column:
    return F.min(F.when(counts & (age_days >= 0), age_days)).alias("least_age")


# --- variant N ------------------------------------------------------------------
def with_category(transactions: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Fact rows with their product's category; the dimension is narrowed to two columns."""
    return transactions.join(products.select("product_id", "category"), "product_id", how)


def transaction_rollup_n(
    transactions: DataFrame,
    products: DataFrame | None,
    as_of: Column,
    windows: Sequence[int] = fixed.ACTIVITY_WINDOWS,
) -> DataFrame:
    """One row per identified customer. Without products, no favourite category."""
    day = F.to_date("transaction_timestamp")
    known = transactions.filter(F.col("customer_id").isNotNull())
    if products is None:
        with_categories = known.withColumn("category", F.lit(None).cast("string"))
    else:
        with_categories = with_category(known, products)
    rows = with_categories.select(
        "customer_id", "channel", "category", "is_completed_transaction", "is_refund_or_return",
        cents(F.col("gross_amount")).alias("amount"),
        day.alias("day"),
        F.datediff(as_of, day).alias("age"),
    )
    amount, channel = F.col("amount"), F.col("channel")
    return rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if("is_completed_transaction").alias("completed_transactions"),
        F.sum(amount).alias("total_cents"),
        _sum_cents(channel == fixed.ECOMMERCE, amount).alias("ecommerce_cents"),
        _sum_cents(channel == fixed.IN_STORE, amount).alias("instore_cents"),
        F.count("amount").alias("priced_transactions"),
        F.min("day").alias("first_purchase_date"),
        F.max("day").alias("last_purchase_date"),
        _least_age(F.lit(True), F.col("age")),
        F.count_if("is_refund_or_return").alias("refund_return_count"),
        most_frequent(channel).alias("preferred_channel"),
        most_frequent(F.col("category")).alias("favorite_category"),
        *activity_measures(F.lit(True), amount, F.col("age"), windows),
    )


def finish_metrics_n(df: DataFrame, windows: Sequence[int] = fixed.ACTIVITY_WINDOWS) -> DataFrame:
    """Money from cents, defaults for customers without transactions, recency and average."""
    money = ["total_cents", "ecommerce_cents", "instore_cents"] + [f"cents_last_{d}d" for d in windows]
    counts = ["total_transactions", "completed_transactions", "refund_return_count"] + [
        f"transactions_last_{d}d" for d in windows
    ]
    return df.withColumns(
        {
            **_money(money),
            **_defaults(dict.fromkeys(counts, 0)),
            "avg_order_value": guarded_ratio(from_cents(F.col("total_cents")), F.col("priced_transactions")),
            "customer_lifetime_value_proxy": from_cents(F.coalesce(F.col("total_cents"), F.lit(0))),
            "days_since_last_purchase": _recency(),
        }
    )


def profile_n(
    customers: DataFrame,
    loyalty: DataFrame,
    rollup: DataFrame,
    as_of: Column,
    windows: Sequence[int] = fixed.ACTIVITY_WINDOWS,
) -> DataFrame:
    """One wide row per customer from silver tables; 360, features and scores are projections of it.

    All three inputs are partitioned on customer_id by their own dedup or grouping,
    so the two left joins add no exchange.
    """
    joined = customers.join(loyalty.drop("status", "member_since"), "customer_id", "left").join(
        rollup, "customer_id", "left"
    )
    return finish_metrics_n(joined, windows)


def customer_360_n(profile: DataFrame) -> DataFrame:
    return profile.select(*C360_N)


# --- variant P ------------------------------------------------------------------
def transaction_rollup_p(
    orders: DataFrame,
    pos: DataFrame,
    products: DataFrame,
    as_of: Column,
    windows: Sequence[int] = fixed.ACTIVITY_WINDOWS,
) -> DataFrame:
    known = F.col("customer_id").isNotNull()
    category = products.select("product_id", F.struct(F.col("category").alias("value")).alias("category"))
    online = (
        orders.filter(known & F.col("order_status").isin(fixed.COMPLETED, *fixed.REFUND_STATUSES_P))
        .join(category, "product_id", "left")
        .select(
            "customer_id",
            F.lit(True).alias("online"),
            (F.col("order_status") == fixed.COMPLETED).alias("completed"),
            cents(F.col("order_amount")).alias("amount"),
            F.col("order_date").alias("at"),
            F.struct(F.col("channel").alias("value")).alias("channel"),
            "category",
        )
    )
    in_store = pos.filter(known & (F.col("transaction_status") == fixed.COMPLETED)).select(
        "customer_id",
        F.lit(False).alias("online"),
        F.lit(True).alias("completed"),
        cents(F.col("transaction_amount")).alias("amount"),
        F.col("transaction_date").alias("at"),
    )
    completed = F.col("completed")
    order = F.col("online") & completed
    sale = ~F.col("online") & completed
    amount, at = F.col("amount"), F.col("at")
    # midnight of as_of - n days is the boundary
    age = F.datediff(as_of, at)
    return (
        online.unionByName(in_store, allowMissingColumns=True)
        .groupBy("customer_id")
        .agg(
            F.count_if(order).alias("ecom_orders"),
            _sum_cents(order, amount).alias("ecom_cents"),
            F.count_if(sale).alias("pos_orders"),
            _sum_cents(sale, amount).alias("pos_cents"),
            F.count_if(F.col("online") & ~completed).alias("refund_return_count"),
            F.min(F.when(order, at)).alias("first_purchase_date"),
            F.max(F.when(order, at)).alias("last_purchase_date"),
            _least_age(order, age),
            most_frequent(F.when(order, F.col("category")), keep_null=True).alias("favorite_category"),
            most_frequent(F.when(order, F.col("channel")), keep_null=True).alias("preferred_channel"),
            *activity_measures(completed, amount, age, windows),
        )
    )


def _top_by_count(counted: DataFrame, value: str, alias: str) -> DataFrame:
    return keep_one(counted, ["customer_id"], [F.desc("n"), value]).select("customer_id", F.col(value).alias(alias))


def favorite_category_p(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Top category of completed online orders, as a table of its own.

    Counting before ranking keeps a customer with very many orders to one row
    per category.
    """
    done = orders.filter(F.col("customer_id").isNotNull() & (F.col("order_status") == fixed.COMPLETED))
    counted = with_category(done, products, "inner").groupBy("customer_id", "category")
    return _top_by_count(counted.agg(F.count(F.lit(1)).alias("n")), "category", "favorite_category")


def preferred_channel_p(orders: DataFrame) -> DataFrame:
    done = orders.filter(F.col("customer_id").isNotNull() & (F.col("order_status") == fixed.COMPLETED))
    counted = done.groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("n"))
    return _top_by_count(counted, "channel", "preferred_channel")


def profile_p(
    customers: DataFrame,
    loyalty: DataFrame,
    rollup: DataFrame,
    as_of: Column,
    windows: Sequence[int] = fixed.ACTIVITY_WINDOWS,
) -> DataFrame:
    counts = ["ecom_orders", "pos_orders", "refund_return_count"] + [f"transactions_last_{d}d" for d in windows]
    total = F.col("ecom_orders") + F.col("pos_orders")
    total_cents = F.col("ecom_cents") + F.col("pos_cents")
    joined = customers.join(loyalty.drop("status", "member_since"), "customer_id", "left").join(
        rollup, "customer_id", "left"
    )
    return (
        joined.withColumns(
            {
                **_defaults(dict.fromkeys(counts + ["ecom_cents", "pos_cents", "points_balance"], 0)),
                **_money([f"cents_last_{d}d" for d in windows]),
                "full_name": full_name(),
                "is_loyalty_member": F.col("loyalty_tier").isNotNull(),
                "days_since_last_purchase": _recency(),
                "customer_tenure_days": F.coalesce(F.datediff(as_of, F.col("registration_date")), F.lit(0)),
            }
        )
        .withColumns(
            {
                "total_transactions": total,
                "completed_transactions": F.col("ecom_orders"),
                "total_revenue": from_cents(total_cents),
                "ecommerce_revenue": from_cents(F.col("ecom_cents")),
                "instore_revenue": from_cents(F.col("pos_cents")),
                "avg_order_value": guarded_ratio(from_cents(total_cents), total),
                "customer_lifetime_value_proxy": from_cents(total_cents),
            }
        )
    )


def customer_360_p(profile: DataFrame) -> DataFrame:
    return profile.select(*C360_P)
