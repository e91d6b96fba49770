"""Silver tables: cleansed and conformed, in both variants.

Variant N conforms both channels into one transaction table. Variant P keeps the
channels apart and applies declared quality rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.ladders import ladder
from keepwell.functions.text import full_name, title
from keepwell.operators import quality
from keepwell.operators.dedup import first_products, latest_customers, latest_loyalty


# --- variant N ------------------------------------------------------------------
def customers_n(bronze: DataFrame, as_of: Column) -> DataFrame:
    valid = F.col("customer_id").isNotNull() & F.col("email").isNotNull() & F.col("registration_date").isNotNull()
    return latest_customers(bronze).select(
        "customer_id",
        full_name().alias("full_name"),
        F.lower(F.trim("email")).alias("email"),
        "phone",
        "registration_date",
        "city",
        "state",
        "country",
        F.datediff(as_of, F.col("registration_date")).alias("customer_tenure_days"),
        valid.alias("is_customer_record_valid"),
    )


def loyalty_n(bronze: DataFrame) -> DataFrame:
    points = F.col("points_balance")
    return latest_loyalty(bronze).select(
        "customer_id",
        title(F.col("loyalty_tier")).alias("loyalty_tier"),
        F.when(points < 0, F.lit(0)).otherwise(points).alias("points_balance"),
        "member_since",
        title(F.col("status")).alias("status"),
        F.lit(True).alias("is_loyalty_member"),
    )


def products_n(bronze: DataFrame, title_brand: bool = True) -> DataFrame:
    """Products with a positive price; brands keep inner capitals when title_brand is off."""
    brand = F.trim("brand")
    return (
        first_products(bronze)
        .filter(F.col("price") > 0)
        .select(
            "product_id",
            F.trim("product_name").alias("product_name"),
            title(F.col("category")).alias("category"),
            (F.initcap(brand) if title_brand else brand).alias("brand"),
            "price",
        )
    )


def _as_transactions(df: DataFrame, renames: dict[str, str], source: str) -> DataFrame:
    return df.withColumnsRenamed(renames).withColumn("source_system", F.lit(source))


def transactions_unified(orders: DataFrame, pos: DataFrame) -> DataFrame:
    """Both channels as one fact table; online rows carry NULL store columns."""
    online = _as_transactions(
        orders,
        {
            "order_id": "transaction_id",
            "order_date": "transaction_timestamp",
            "order_amount": "gross_amount",
            "order_status": "transaction_status",
        },
        fixed.SOURCE_ECOMMERCE,
    )
    in_store = _as_transactions(
        pos,
        {"transaction_date": "transaction_timestamp", "transaction_amount": "gross_amount"},
        fixed.SOURCE_POS,
    )
    status = F.col("transaction_status")
    return (
        online.unionByName(in_store, allowMissingColumns=True)
        .filter(F.col("product_id").isNotNull() & (F.col("quantity") > 0) & (F.col("gross_amount") > 0))
        .select(
            "transaction_id",
            "customer_id",
            "product_id",
            "transaction_timestamp",
            "quantity",
            "gross_amount",
            "transaction_status",
            "channel",
            "payment_method",
            "store_id",
            "store_name",
            "store_city",
            "store_state",
            "source_system",
            F.coalesce(status == fixed.COMPLETED, F.lit(False)).alias("is_completed_transaction"),
            F.coalesce(status.isin(*fixed.REFUND_STATUSES_N), F.lit(False)).alias("is_refund_or_return"),
            F.col("customer_id").isNotNull().alias("is_customer_identified"),
        )
    )


def segment(tier: Column, tenure_days: Column) -> Column:
    outsider = tier == fixed.NON_MEMBER
    return ladder(
        [(tier == name, value) for name, value in fixed.SEGMENT_BY_TIER.items()]
        + [
            (outsider & (tenure_days > fixed.NEW_CUSTOMER_DAYS), fixed.SEGMENT_OLD_NON_MEMBER),
            (outsider & (tenure_days <= fixed.NEW_CUSTOMER_DAYS), fixed.SEGMENT_NEW_NON_MEMBER),
        ],
        fixed.SEGMENT_OTHER,
    )


def customer_identity(customers: DataFrame, loyalty: DataFrame) -> DataFrame:
    return (
        customers.join(loyalty, "customer_id", "left")
        .select(
            "customer_id",
            "full_name",
            "email",
            "phone",
            "registration_date",
            "city",
            "state",
            "country",
            "customer_tenure_days",
            F.coalesce("loyalty_tier", F.lit(fixed.NON_MEMBER)).alias("loyalty_tier"),
            F.coalesce("points_balance", F.lit(0)).alias("points_balance"),
            "member_since",
            F.coalesce("status", F.lit(fixed.NON_MEMBER)).alias("loyalty_status"),
            F.coalesce("is_loyalty_member", F.lit(False)).alias("is_loyalty_member"),
            "is_customer_record_valid",
        )
        .withColumn("customer_segment", segment(F.col("loyalty_tier"), F.col("customer_tenure_days")))
    )


# --- variant P ------------------------------------------------------------------
def project_products_p(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        F.initcap("category").alias("category"),
        F.trim("brand").alias("brand"),
        F.col("price").try_cast("double").alias("price"),
    )


def project_customers_p(bronze: DataFrame) -> DataFrame:
    trimmed = {name: F.trim(name).alias(name) for name in ("first_name", "last_name", "city", "state", "country")}
    return bronze.select(
        "customer_id",
        trimmed["first_name"],
        trimmed["last_name"],
        F.lower(F.trim("email")).alias("email"),
        "phone",
        F.col("registration_date").try_cast("date").alias("registration_date"),
        trimmed["city"],
        trimmed["state"],
        trimmed["country"],
    )


def project_loyalty_p(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "customer_id",
        "loyalty_tier",
        F.col("points_balance").try_cast("long").alias("points_balance"),
        F.col("member_since").try_cast("date").alias("member_since"),
        "status",
    )


def project_orders_p(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("order_date").try_cast("timestamp_ntz").alias("order_date"),
        F.col("quantity").try_cast("long").alias("quantity"),
        F.col("order_amount").try_cast("double").alias("order_amount"),
        "order_status",
        "channel",
        "payment_method",
    )


def project_pos_p(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "transaction_id",
        "customer_id",
        "product_id",
        F.col("transaction_date").try_cast("timestamp_ntz").alias("transaction_date"),
        F.col("quantity").try_cast("long").alias("quantity"),
        F.col("transaction_amount").try_cast("double").alias("transaction_amount"),
        "transaction_status",
        "channel",
        "store_id",
        "store_name",
        "store_city",
        "store_state",
        "payment_method",
    )


# dataset -> (projection, rules); rows and streams go through the same two steps.
SILVER_P = {
    "products": (project_products_p, quality.PRODUCT_RULES),
    "customers": (project_customers_p, quality.CUSTOMER_RULES),
    "loyalty": (project_loyalty_p, quality.LOYALTY_RULES),
    "orders": (project_orders_p, quality.ORDER_RULES),
    "pos": (project_pos_p, quality.POS_RULES),
}


def silver_p(dataset: str, bronze: DataFrame) -> DataFrame:
    project, rules = SILVER_P[dataset]
    return quality.drop_violators(project(bronze), rules)


# --- distributions and small reports over silver -----------------------------------
def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def transactions_profile(transactions: DataFrame) -> DataFrame:
    """All counts of the unified table in one pass."""
    counted = transactions.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("channel") == fixed.ECOMMERCE).alias("ecommerce_rows"),
        F.count_if(F.col("channel") == fixed.IN_STORE).alias("instore_rows"),
        F.count_if("is_completed_transaction").alias("completed_rows"),
        F.count_if("is_customer_identified").alias("identified_rows"),
    )
    whole = F.col("total_rows")
    return counted.withColumns(
        {
            f"{name}_pct": F.when(whole > 0, F.col(f"{name}_rows") * 100.0 / whole).otherwise(0.0)
            for name in ("completed", "identified")
        }
    )


def loyalty_penetration(identity: DataFrame) -> DataFrame:
    counted = identity.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if("is_loyalty_member").alias("members"),
    )
    whole = F.col("customers")
    return counted.withColumn("non_members", whole - F.col("members")).withColumns(
        {
            f"{name}_pct": F.when(whole > 0, F.col(f"{name}s") * 100.0 / whole).otherwise(0.0)
            for name in ("member", "non_member")
        }
    )
