"""Customer measures kept as state, moved on by what is new in silver.

The state is additive: per customer and day the counts, cents and first and last purchase; per customer, product
and channel the number of completed online orders. A run reads the silver batches that it has not seen, pre-aggregates
them and adds the result as a batch of its own, each once whatever happens. Sums over all batches give
what a full refresh finds. Compacting folds the batches into one, so the state stays as small as its keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.money import cents
from keepwell.plans.customer360 import activity_sums
from keepwell.session import shuffles_freed
from keepwell.sources.versions import VersionLog
from keepwell.streaming.ingest import each_batch
from keepwell.streaming.schemas import conformed, merged
from keepwell.streaming.sink import BatchSink

DAY = ("customer_id", "day")
CHOICE = ("customer_id", "product_id", "channel")


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def merged_rows(part: str, rows: DataFrame) -> DataFrame:
    """The rows of a part of the state, merged to one for each key."""
    if part == "choices":
        return rows.groupBy(*CHOICE).agg(*_sums("n"))
    return rows.groupBy(*DAY).agg(
        *_sums("ecom_orders", "ecom_cents", "pos_orders", "pos_cents", "refund_return_count"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
    )


PARTS = ("days", "choices")


def days_of_orders(orders: DataFrame) -> DataFrame:
    known = orders.filter(F.col("customer_id").isNotNull() & F.col("order_status").isin(fixed.COMPLETED, *fixed.REFUND_STATUSES_P))
    done = F.col("order_status") == fixed.COMPLETED
    at, zero = F.col("order_date"), F.lit(0).cast("long")
    return known.groupBy("customer_id", F.to_date(at).alias("day")).agg(
        F.count_if(done).alias("ecom_orders"),
        F.coalesce(F.sum(F.when(done, cents(F.col("order_amount")))), zero).alias("ecom_cents"),
        zero.alias("pos_orders"), zero.alias("pos_cents"),
        F.count_if(~done).alias("refund_return_count"),
        F.min(F.when(done, at)).alias("first_at"), F.max(F.when(done, at)).alias("last_at"),
    )


def days_of_sales(pos: DataFrame) -> DataFrame:
    known = pos.filter(F.col("customer_id").isNotNull() & (F.col("transaction_status") == fixed.COMPLETED))
    at, zero = F.col("transaction_date"), F.lit(0).cast("long")
    never = F.lit(None).cast(pos.schema["transaction_date"].dataType)
    return known.groupBy("customer_id", F.to_date(at).alias("day")).agg(
        zero.alias("ecom_orders"), zero.alias("ecom_cents"),
        F.count(F.lit(1)).alias("pos_orders"),
        F.coalesce(F.sum(cents(F.col("transaction_amount"))), zero).alias("pos_cents"),
        zero.alias("refund_return_count"), never.alias("first_at"), never.alias("last_at"),
    )


def choices_of_orders(orders: DataFrame) -> DataFrame:
    done = orders.filter(F.col("customer_id").isNotNull() & (F.col("order_status") == fixed.COMPLETED))
    return done.groupBy(*CHOICE).agg(F.count(F.lit(1)).alias("n"))


# Where each silver dataset's new rows go, and what they are reduced to.
FEEDS: tuple[tuple[str, str, Callable[[DataFrame], DataFrame]], ...] = (
    ("orders", "days", days_of_orders),
    ("orders", "choices", choices_of_orders),
    ("pos", "days", days_of_sales),
)


class CustomerState:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.parts = {name: BatchSink(spark, f"{self.base}/{name}") for name in PARTS}
        self._folds = {name: VersionLog(spark, f"{self.base}/{name}/_folds") for name in PARTS}

    def advance(self, silver: dict[str, BatchSink], files_per_batch: int = 1000) -> None:
        """Take in the silver batches that have not been taken in yet."""
        for dataset, part, reduced in FEEDS:

            def take(rows: DataFrame, name: str, dataset=dataset, part=part, reduced=reduced) -> None:
                self.parts[part].write(rows, f"{dataset}-{name}", {"rows": F.count(F.lit(1))}, reduced)

            each_batch(silver[dataset], f"{self.base}/checkpoints/{dataset}-{part}", f"state_{dataset}_{part}", take, files_per_batch)

    def _folded(self, part: str) -> tuple[DataFrame | None, set[str]]:
        """The rows folded last, and the batches they stand for."""
        log = self._folds[part]
        newest = log.latest()
        if not newest:
            return None, set()
        entry = log.entry(newest)
        return self.spark.read.parquet(f"{self.base}/{part}/{entry['folder']}"), set(entry["batches"])

    def _rows(self, part: str) -> DataFrame:
        """The last fold and the batches since: a key may have a row in each."""
        folded, batches = self._folded(part)
        rows = self.parts[part].read(without=batches)
        if folded is None:
            return rows
        wide = merged([folded.schema, rows.schema] if rows is not None else [folded.schema])
        return conformed(folded, wide) if rows is None else conformed(folded, wide).unionByName(conformed(rows, wide))

    def read(self, part: str) -> DataFrame:
        """One row per key of a part of the state."""
        return merged_rows(part, self._rows(part))

    def compact(self) -> None:
        """Fold all batches of each part into one; a reader finds either the old ones or the fold."""
        for part, log in self._folds.items():
            after = log.latest()
            batches = self.parts[part].batches()
            folder = f"_folded/{uuid.uuid4().hex}"
            with shuffles_freed(self.spark):
                self.read(part).write.option("compression", "zstd").parquet(f"{self.base}/{part}/{folder}")
            log.commit({"folder": folder, "batches": sorted({*batches, *self._folded(part)[1]})}, after)
            if after:
                log.files.delete(f"{self.base}/{part}/{log.entry(after)['folder']}")

    def rollup(self, products: DataFrame, as_of: Column, windows=fixed.ACTIVITY_WINDOWS) -> DataFrame:
        """The measures of every customer, as a grouping of all transactions gives them.

        They are sums, least and greatest values, so rows of one key need not be merged before.
        """
        days = self._rows("days")
        age = F.datediff(as_of, F.col("day"))
        measures = days.groupBy("customer_id").agg(
            *_sums("ecom_orders", "ecom_cents", "pos_orders", "pos_cents", "refund_return_count"),
            F.min("first_at").alias("first_purchase_date"), F.max("last_at").alias("last_purchase_date"),
            F.min(F.when((F.col("ecom_orders") > 0) & (age >= 0), age)).alias("least_age"),
            *activity_sums(F.col("ecom_orders") + F.col("pos_orders"), F.col("ecom_cents") + F.col("pos_cents"), age, windows),
        )
        choices = self._rows("choices")
        category = products.select("product_id", F.struct(F.col("category").alias("value")).alias("value"))
        of_category = _most_frequent(choices.join(category, "product_id"), "favorite_category")
        of_channel = _most_frequent(choices.withColumn("value", F.struct(F.col("channel").alias("value"))), "preferred_channel")
        return measures.join(of_category, "customer_id", "left").join(of_channel, "customer_id", "left")


def _most_frequent(counted: DataFrame, name: str) -> DataFrame:
    """Each customer's value with the largest count; the lowest one on a tie, NULL before all others."""
    summed = counted.groupBy("customer_id", "value").agg(F.sum("n").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("value")))
    return summed.groupBy("customer_id").agg(best.alias("best")).select("customer_id", F.col("best.value.value").alias(name))
