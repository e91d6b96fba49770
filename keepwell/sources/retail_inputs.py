"""Retail source frames derived from the supplied star-schema tables.

The five frames have the shape the pipelines expect (products, customers,
loyalty profiles, online orders, store transactions), with planted duplicates
and faults so that every cleansing rule meets real work.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.dedup import keep_one_at
from keepwell.session import shuffles_freed

AS_OF = "2001-08-01"
FIRST_REGISTRATION = "1998-08-02"


class RetailInputs:
    """Lazy frames over one folder of parquet tables.

    `as_of` is the day that recency, tenure and activity count from. Every row takes part; only an
    earlier state, as change feeds compare, is limited to the rows up to a day by `until`.
    """

    def __init__(self, spark: SparkSession, folder: str, as_of: str = AS_OF, until: str | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = as_of
        self.until = until
        self.kept: str | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def as_of_day(self):
        return F.to_date(F.lit(self.as_of))

    def _until(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of an earlier state; the column is compared as it is, so the filter reaches the scan."""
        if self.until is None:
            return df
        day_after = F.date_add(F.to_date(F.lit(self.until)), 1).cast(df.schema[column].dataType)
        return df.filter(F.col(column) < day_after)

    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        copies = F.when(key % 10 == 0, F.array(F.lit(" "), F.lit("  v2"))).otherwise(F.array(F.lit(" ")))
        return (
            self.table("part")
            .withColumn("suffix", F.explode(copies))
            .select(
                key.alias("product_id"),
                F.concat(F.lit("  "), "p_name", "suffix").alias("product_name"),
                F.col("p_type").alias("category"),
                F.col("p_brand").alias("brand"),
                F.when(key % 97 == 0, F.lit(0.0))
                .when(key % 89 == 0, F.lit(None))
                .otherwise(F.col("p_retailprice"))
                .alias("price"),
            )
        )

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        digits = F.lpad(key.cast("string"), 7, "0")
        registered = F.date_add(F.to_date(F.lit(FIRST_REGISTRATION)), (key * 7 % 1095).cast("int"))
        newest = F.struct(F.lit(0).alias("age"), F.lit("+1-555-").alias("prefix"))
        older = F.struct(F.lit(100).alias("age"), F.lit("+1-444-").alias("prefix"))
        copies = F.when(key % 20 == 0, F.array(newest, older)).otherwise(F.array(newest))
        rows = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .withColumn("copy", F.explode(copies))
            .select(
                key.alias("customer_id"),
                F.col("c_mktsegment").alias("first_name"),
                F.col("c_name").alias("last_name"),
                F.when(key % 50 == 0, F.lit(None))
                .when(key % 51 == 0, F.lit("bad-address"))
                .otherwise(
                    F.concat(F.lit("  "), F.upper("c_mktsegment"), key.cast("string"), F.lit("@MAIL.COM"))
                )
                .alias("email"),
                F.concat("copy.prefix", digits).alias("phone"),
                F.date_sub(registered, F.col("copy.age")).alias("registration_date"),
                F.col("n_name").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
            )
        )
        return self._until(rows, "registration_date")

    def loyalty(self) -> DataFrame:
        key = F.col("c_custkey")
        spread = key * 7 % 100
        joined = F.date_add(
            F.to_date(F.lit(FIRST_REGISTRATION)), (key * 7 % 1095 + 30 + key % 151).cast("int")
        )
        return (
            self.table("customer")
            .filter(key % 10 < 7)
            .select(
                key.alias("customer_id"),
                F.when(spread < 60, " bronze")
                .when(spread < 85, "SILVER ")
                .when(spread < 97, "Gold")
                .otherwise("platinum")
                .alias("loyalty_tier"),
                F.floor(F.col("c_acctbal") * 10).cast("long").alias("points_balance"),
                joined.alias("member_since"),
                F.lit(" active").alias("status"),
            )
        )

    def _lines(self) -> DataFrame:
        """One row per (order, line), with its buyer.

        Lines move once, by order: the dedup and the join share that exchange. Lines of
        crowded orders are pruned map-side before theirs (a row_number limit), so a
        heavily repeated line costs one row per task. The two flags travel as one number.
        """
        if self.kept:
            return self.spark.read.parquet(self.kept)
        lines = self._until(self.table("lineitem"), "l_shipdate")
        single = keep_one_at(
            lines.withColumn("flags", self._flags()).drop("l_linestatus", "l_returnflag"),
            ["l_orderkey", "l_linenumber"],
            [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
            "l_orderkey",
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.when(F.col("o_custkey") % 25 != 0, F.col("o_custkey")).alias("buyer"),
            "o_orderpriority",
        )
        near, apart = (part.join(orders, "l_orderkey") for part in single)
        return near.unionByName(apart)

    @staticmethod
    def _flags():
        """Tens: 1 online, 2 in store, 0 neither; ones: 1 returned, 2 cancelled, 0 completed."""
        channel = F.when(F.col("l_linestatus") == "O", 10).when(F.col("l_linestatus") == "F", 20).otherwise(0)
        cancelled = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
        status = F.when(F.col("l_returnflag") == "R", 1).when(cancelled, 2).otherwise(0)
        return (channel + status).cast("byte")

    def stored(self, path: str) -> RetailInputs:
        """The same frames over lines that are paired with their buyers once: orders and pos scan the stored rows."""
        with shuffles_freed(self.spark):
            self._lines().write.option("compression", "zstd").parquet(path)
        same = RetailInputs(self.spark, self.folder, self.as_of, self.until)
        same.kept = path
        return same

    @staticmethod
    def _line_id():
        return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    @staticmethod
    def _status(returned: str):
        status = F.col("flags") % 10
        return F.when(status == 1, returned).when(status == 2, "Cancelled").otherwise("Completed")

    def orders(self) -> DataFrame:
        return (
            self._lines()
            .filter(F.col("flags").between(10, 19))
            .select(
                self._line_id().alias("order_id"),
                F.col("buyer").alias("customer_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_shipdate").alias("order_date"),
                F.col("l_quantity").cast("long").alias("quantity"),
                F.col("l_extendedprice").alias("order_amount"),
                self._status("Returned").alias("order_status"),
                F.lit("Ecommerce").alias("channel"),
                F.col("o_orderpriority").alias("payment_method"),
            )
        )

    def pos(self) -> DataFrame:
        store = (F.col("l_suppkey") % 8 + 1).cast("string")
        return (
            self._lines()
            .filter(F.col("flags").between(20, 29))
            .select(
                self._line_id().alias("transaction_id"),
                F.when(F.col("l_suppkey") % 5 >= 2, F.col("buyer")).alias("customer_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_shipdate").alias("transaction_date"),
                F.col("l_quantity").cast("long").alias("quantity"),
                F.col("l_extendedprice").alias("transaction_amount"),
                self._status("Refunded").alias("transaction_status"),
                F.lit("In-Store").alias("channel"),
                F.concat(F.lit("ST"), F.lpad(store, 3, "0")).alias("store_id"),
                F.concat(F.lit("Store "), store).alias("store_name"),
                F.concat(F.lit("City "), store).alias("store_city"),
                F.concat(F.lit("S"), store).alias("store_state"),
                F.col("o_orderpriority").alias("payment_method"),
            )
        )

    def dirty_orders(self) -> DataFrame:
        """Orders with planted faults: missing ids, zero quantities, negative amounts."""
        order_number = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("long")
        return self.orders().withColumns(
            {
                "order_id": F.when(order_number % 101 != 0, F.col("order_id")),
                "quantity": F.when(F.col("product_id") % 107 == 0, F.lit(0)).otherwise(F.col("quantity")),
                "order_amount": F.when(F.col("product_id") % 103 == 0, -F.col("order_amount")).otherwise(
                    F.col("order_amount")
                ),
            }
        )

    def dirty_loyalty(self) -> DataFrame:
        """Loyalty profiles with an unknown tier planted."""
        return self.loyalty().withColumn(
            "loyalty_tier",
            F.when(F.col("customer_id") % 61 == 0, "Diamond").otherwise(F.col("loyalty_tier")),
        )
