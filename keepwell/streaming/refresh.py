"""The whole incremental path: five landing folders to streamed silver, then the gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators import dedup
from keepwell.plans import customer360
from keepwell.plans.medallion import GoldTables, refresh_gold
from keepwell.streaming import ingest
from keepwell.streaming.schemas import wider
from keepwell.streaming.sink import BatchSink


@dataclass(frozen=True)
class Streamed:
    """The tables of one dataset's stream."""

    bronze: BatchSink
    silver: BatchSink


def stream_to_silver(
    spark: SparkSession,
    landing: Mapping[str, str],
    base: str,
    files_per_batch: int = 1000,
    schemas: Mapping[str, str] = ingest.LANDING,
) -> dict[str, Streamed]:
    """Take what has arrived in each landing folder; returns the tables per dataset.

    schemas: the columns declared to begin with; they widen with what lands. The datasets are independent
    streams and run side by side. Calling this again on the same base continues from the checkpoints.
    """

    def one(dataset: str) -> tuple[str, Streamed]:
        folder = f"{base}/{dataset}"
        bronze = ingest.ingest(
            spark, landing[dataset], f"{folder}/bronze", f"{folder}/checkpoints/bronze", schemas[dataset], files_per_batch,
            f"bronze_{dataset}",
        )
        silver = ingest.refine(
            spark, dataset, f"{folder}/bronze", f"{folder}/silver", f"{folder}/checkpoints/silver", files_per_batch
        )
        return dataset, Streamed(bronze, silver)

    with ThreadPoolExecutor(max_workers=len(landing)) as pool:
        return dict(pool.map(one, landing))


KEYS = ("customer_id", "product_id")


def with_common_keys(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with each key in the widest type that any of them has: ids that are text in one are text in all."""
    out = dict(tables)
    for key in KEYS:
        holders = [name for name, df in out.items() if key in df.columns]
        kind = "void"
        for name in holders:
            kind = wider(kind, out[name].schema[key].dataType.simpleString())
        for name in holders:
            out[name] = out[name].withColumn(key, F.col(key).cast(kind))
    return out


def profile_from_silver(streamed: Mapping[str, Streamed], as_of: Column) -> DataFrame:
    """Variant P customer profile over the streamed tables, duplicates removed first."""
    tables = with_common_keys({dataset: tables.silver.read() for dataset, tables in streamed.items()})
    rollup = customer360.transaction_rollup_p(
        tables["orders"], tables["pos"], dedup.first_products(tables["products"]), as_of
    )
    return customer360.profile_p(
        dedup.latest_customers(tables["customers"]), dedup.latest_loyalty(tables["loyalty"]), rollup, as_of
    )


@dataclass(frozen=True)
class Refreshed(GoldTables):
    """Gold tables with what their streams have taken, ever, by dataset."""

    landed: Mapping[str, Streamed]

    def landing_report(self) -> DataFrame:
        """(dataset, rows, rescued): rows that landed, and those of which something fitted no column."""
        rows = []
        for dataset, tables in self.landed.items():
            totals = tables.bronze.totals()
            rows.append((dataset, totals.get("rows", 0), totals.get("rescued", 0)))
        return self.spark.createDataFrame(rows, "dataset string, rows long, rescued long")


def refresh(
    spark: SparkSession,
    landing: Mapping[str, str],
    base: str,
    database: str,
    as_of: Column,
    schemas: Mapping[str, str] = ingest.LANDING,
) -> Refreshed:
    """One triggered refresh: new files to silver, then a full refresh of gold."""
    streamed = stream_to_silver(spark, landing, base, schemas=schemas)
    gold = refresh_gold(spark, database, f"{base}/gold", profile_from_silver(streamed, as_of), None, "P")
    return Refreshed(gold.spark, gold.database, gold.base, streamed)
