"""Refresh of the gold tables: one wide profile is written, the gold tables are cut from it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from keepwell.plans import actions, churn, customer360
from keepwell.plans.kpis import kpis_from_partials
from keepwell.sources.served import ServedCopy, sync
from keepwell.sources.tables import create_database, publish, table_at, table_feed, version_log

COMMENTS = {
    "customer_profile": "One wide row per customer behind the gold tables",
    "gold_customer_360": "Customer profile, loyalty, channel revenue and recency",
    "gold_customer_churn_features": "Model-ready churn features",
    "gold_customer_churn_scores": "Rule-based churn scores, bands and reasons",
    "gold_next_best_actions": "Offer, action and message per customer",
    "gold_executive_kpis": "Daily KPIs per channel",
    "gold_daily_partials": "Mergeable daily figures per channel, with the buyers",
}


@dataclass(frozen=True)
class GoldTables:
    spark: SparkSession
    database: str
    base: str

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def latest(self, name: str) -> int:
        """Number of a table's newest version."""
        return version_log(self.spark, f"{self.database}.{name}", self.base).latest()

    def at(self, name: str, version: int) -> DataFrame:
        return table_at(self.spark, f"{self.database}.{name}", self.base, version)

    def feed(self, name: str, old: int, new: int, key: str = "customer_id") -> DataFrame:
        """The row-level changes between two refreshes."""
        return table_feed(self.spark, f"{self.database}.{name}", self.base, old, new, key)

    def sync(self, name: str, copy: ServedCopy) -> int:
        """Bring a served copy to the newest refresh."""
        return sync(self.spark, f"{self.database}.{name}", self.base, copy)


def refresh_gold(
    spark: SparkSession,
    database: str,
    base: str,
    profile: DataFrame,
    kpis: DataFrame | None,
    variant: str,
    partials: DataFrame | None = None,
) -> GoldTables:
    """Publish the gold tables of a variant from its customer profile, and the daily KPIs.

    With the partial figures of each day, these are stored and the KPIs are merged from the stored rows.

    Joins and aggregates run once, for the profile; 360, features, scores and
    actions are row-wise projections of the stored rows. All customer tables share
    one bucketing on customer_id.
    """
    create_database(spark, database, f"Customer gold tables, variant {variant}")

    def put(name: str, df: DataFrame, key: str | None = "customer_id") -> DataFrame:
        return publish(df, f"{database}.{name}", base, COMMENTS[name], key)

    def put_daily() -> None:
        figures = kpis
        if partials is not None:
            figures = kpis_from_partials(put("gold_daily_partials", partials, None))
        if figures is not None:
            put("gold_executive_kpis", figures, None)

    with ThreadPoolExecutor() as pool:
        # independent of the profile, so it runs beside it
        daily = pool.submit(put_daily)
        stored = put("customer_profile", profile)
        if variant == "N":
            scored = churn.add_scores_n(churn.add_features_n(stored))
            texts = actions.add_actions_n(scored)
            c360_columns = customer360.C360_N
        else:
            scored = churn.add_scores_p(churn.add_features_p(stored))
            texts = actions.add_actions_p(scored)
            c360_columns = customer360.C360_P
        projections = {
            "gold_customer_360": stored.select(*c360_columns),
            "gold_customer_churn_features": scored.select(*churn.FEATURES),
            "gold_customer_churn_scores": scored.select(*churn.SCORES),
            "gold_next_best_actions": texts.select(*actions.ACTIONS),
        }
        list(pool.map(lambda item: put(*item), projections.items()))
        daily.result()
    return GoldTables(spark, database, base)
