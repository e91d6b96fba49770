"""Source frames as a user has them: stored tables, or any five DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BronzeFrames:
    """Five source frames; `as_of` is the day that recency, tenure and activity count from."""

    products_frame: DataFrame
    customers_frame: DataFrame
    loyalty_frame: DataFrame
    orders_frame: DataFrame
    pos_frame: DataFrame
    as_of: str

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str, as_of: str) -> BronzeFrames:
        names = ("products", "customers", "loyalty_profiles", "ecommerce_orders", "pos_transactions")
        return cls(*[spark.table(f"{database}.bronze_{name}") for name in names], as_of)

    @property
    def as_of_day(self) -> Column:
        return F.to_date(F.lit(self.as_of))

    def products(self) -> DataFrame:
        return self.products_frame

    def customers(self) -> DataFrame:
        return self.customers_frame

    def loyalty(self) -> DataFrame:
        return self.loyalty_frame

    def orders(self) -> DataFrame:
        return self.orders_frame

    def pos(self) -> DataFrame:
        return self.pos_frame
