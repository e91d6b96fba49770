"""All silver and gold frames over one set of source frames, built lazily."""

from __future__ import annotations

from functools import cached_property
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession

from keepwell.operators import dedup
from keepwell.plans import actions, churn, customer360, kpis, silver


class Sources(Protocol):
    """The five source frames and the day they are seen from."""

    @property
    def as_of_day(self) -> Column: ...

    def products(self) -> DataFrame: ...

    def customers(self) -> DataFrame: ...

    def loyalty(self) -> DataFrame: ...

    def orders(self) -> DataFrame: ...

    def pos(self) -> DataFrame: ...


class CustomerTables:
    """Each frame is planned once and shared by everything derived from it."""

    def __init__(self, spark: SparkSession, inputs: Sources):
        self.spark = spark
        self.inputs = inputs
        self.as_of = inputs.as_of_day

    # silver and gold, variant N
    @cached_property
    def customers_n(self) -> DataFrame:
        return silver.customers_n(self.inputs.customers(), self.as_of)

    @cached_property
    def loyalty_n(self) -> DataFrame:
        return silver.loyalty_n(self.inputs.loyalty())

    @cached_property
    def products_n(self) -> DataFrame:
        return silver.products_n(self.inputs.products())

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.transactions_unified(self.inputs.orders(), self.inputs.pos())

    def stored_facts(self, path: str) -> DataFrame:
        """The columns of the transactions that profile and KPIs count, stored once for both."""
        self.transactions.select(*customer360.FACTS).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def identity(self) -> DataFrame:
        return silver.customer_identity(self.customers_n, self.loyalty_n)

    @cached_property
    def rollup_n(self) -> DataFrame:
        return customer360.transaction_rollup_n(self.transactions, self.products_n, self.as_of)

    @cached_property
    def profile_n(self) -> DataFrame:
        return customer360.profile_n(self.customers_n, self.loyalty_n, self.rollup_n, self.as_of)

    @cached_property
    def c360_n(self) -> DataFrame:
        return customer360.customer_360_n(self.profile_n)

    @cached_property
    def features_n(self) -> DataFrame:
        return churn.churn_features_n(self.profile_n)

    @cached_property
    def scored_n(self) -> DataFrame:
        return churn.add_scores_n(churn.add_features_n(self.profile_n))

    @cached_property
    def scores_n(self) -> DataFrame:
        return self.scored_n.select(*churn.SCORES)

    @cached_property
    def actions_n(self) -> DataFrame:
        return actions.add_actions_n(self.scored_n).select(*actions.ACTIONS)

    @cached_property
    def kpis(self) -> DataFrame:
        return kpis.executive_kpis(self.transactions)

    # silver and gold, variant P: duplicates are removed before the joins
    @cached_property
    def customers_p(self) -> DataFrame:
        return silver.silver_p("customers", dedup.latest_customers(self.inputs.customers()))

    @cached_property
    def loyalty_p(self) -> DataFrame:
        return silver.silver_p("loyalty", dedup.latest_loyalty(self.inputs.loyalty()))

    @cached_property
    def products_p(self) -> DataFrame:
        return silver.silver_p("products", dedup.first_products(self.inputs.products()))

    @cached_property
    def orders_p(self) -> DataFrame:
        return silver.silver_p("orders", self.inputs.orders())

    @cached_property
    def pos_p(self) -> DataFrame:
        return silver.silver_p("pos", self.inputs.pos())

    @cached_property
    def rollup_p(self) -> DataFrame:
        return customer360.transaction_rollup_p(self.orders_p, self.pos_p, self.products_p, self.as_of)

    @cached_property
    def profile_p(self) -> DataFrame:
        return customer360.profile_p(self.customers_p, self.loyalty_p, self.rollup_p, self.as_of)

    @cached_property
    def c360_p(self) -> DataFrame:
        return customer360.customer_360_p(self.profile_p)

    @cached_property
    def features_p(self) -> DataFrame:
        return churn.churn_features_p(self.profile_p)

    @cached_property
    def scores_p(self) -> DataFrame:
        return churn.churn_scores_p(self.profile_p)

    @cached_property
    def actions_p(self) -> DataFrame:
        return actions.add_actions_p(churn.add_scores_p(self.profile_p)).select(*actions.ACTIONS)
