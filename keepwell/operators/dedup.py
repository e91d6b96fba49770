"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Catalyst turns the rank filter into a group limit that also runs before the
    shuffle, so each task sends at most one row per key however often the key
    repeats. The order should end in columns that break every tie.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).filter(F.col("__position") == 1).drop("__position")


# Rows are counted in so many buckets of their place; one is crowded from so many rows and times the mean bucket on.
_PLACES = 4096
_CROWD_ROWS = 100_000
_CROWD_TIMES = 4


def _crowded(df: DataFrame, bucket: Column) -> Column:
    """The crowded buckets as one array: at most a quarter of them, found when the query runs."""
    counted = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    whole = counted.agg(F.collect_list(F.struct("bucket", "n")).alias("found"), F.avg("n").alias("mean"))
    least = F.greatest(F.lit(_CROWD_ROWS), F.col("mean") * _CROWD_TIMES)
    return whole.select(F.transform(F.filter("found", lambda b: b["n"] > least), lambda b: b["bucket"])).scalar()


def keep_one_at(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], place: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of keep_one in two frames; the first lies where a join or grouping on `place`, one of the keys, needs it.

    Its rows move once for the dedup and for what follows on `place`. No row is pruned before that move, so the rows
    of crowded places, where a key may repeat without end, make up the second frame: they are pruned first, as keep_one does.
    """
    bucket = F.pmod(F.hash(place), F.lit(_PLACES))
    apart = F.array_contains(_crowded(df, bucket), bucket)
    return keep_one(df.filter(~apart).repartition(place), keys, order), keep_one(df.filter(apart), keys, order)


def latest_customers(customers: DataFrame) -> DataFrame:
    return keep_one(customers, ["customer_id"], [F.desc("registration_date"), "phone"])


def latest_loyalty(loyalty: DataFrame) -> DataFrame:
    return keep_one(
        loyalty, ["customer_id"], [F.desc("member_since"), "loyalty_tier", "points_balance", "status"]
    )


def first_products(products: DataFrame) -> DataFrame:
    return keep_one(products, ["product_id"], ["product_name", "category", "brand", "price"])
