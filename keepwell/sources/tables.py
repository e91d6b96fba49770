"""Catalogue tables over immutable snapshot folders, with a log of their versions.

Every refresh writes a new folder, adds it to the table's log and points the table's name, a view, at
it. The log entry is the switch: before it the new rows do not exist, after it they are the newest version.
Changing the view is one update of the catalogue, so a reader finds the table at any moment, with all the
rows of one version. A reader, or the job that computes the refresh from the same table, keeps the files it
started with; each version carries its own schema and can be read on as long as it is retained.

A writer that dies leaves a folder that no version names. One that dies between log and view leaves the view
one version behind; the next publish, or `point`, moves it on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.sync import SNAPSHOT, snapshot_diff
from keepwell.sources.files import SharedFiles
from keepwell.sources.versions import VersionLog

# Versions that stay readable after a refresh.
RETAINED = 3


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_database(spark: SparkSession, database: str, comment: str = "") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT '{_quoted(comment)}'")


def _home(table: str, base: str) -> str:
    return f"{base.rstrip('/')}/{table.replace('.', '/')}"


def version_log(spark: SparkSession, table: str, base: str) -> VersionLog:
    return VersionLog(spark, f"{_home(table, base)}/_log")


def publish(
    df: DataFrame,
    table: str,
    base: str,
    comment: str = "",
    bucket_key: str | None = None,
    buckets: int | None = None,
    after: int | None = None,
    retain: int = RETAINED,
) -> DataFrame:
    """Write df as the next version of a table and return the table.

    With a bucket key, rows are bucketed and sorted on it: joins of such tables on the
    key (serving lookups, change feed, sync) need no shuffle, and a lookup of one
    key reads one bucket. The default bucket count is the shuffle partition count, so
    a frame already partitioned on the key writes one file per bucket.

    after: the version that df was computed from, by default the newest one now. If there is a newer one when
    the rows are written, ConcurrentUpdate is raised and the table stays as the other writer left it.
    """
    spark = df.sparkSession
    log = version_log(spark, table, base)
    started = log.latest() if after is None else after
    run = uuid.uuid4().hex
    snapshot = f"{table}{SNAPSHOT}{run[:12]}"
    location = f"{_home(table, base)}/snapshot-{run}"
    writer = df.write.format("parquet").option("path", location)
    count = None
    if bucket_key:
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = writer.bucketBy(count, bucket_key).sortBy(bucket_key)
    writer.saveAsTable(snapshot)
    entry = {
        "snapshot": snapshot, "location": location, "schema": df.schema.toDDL(), "comment": comment, "key": bucket_key, "buckets": count,
    }
    try:
        log.commit(entry, started)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {snapshot}")
        log.files.delete(location)
        raise
    point(spark, table, base)
    _retain(spark, table, base, retain)
    return spark.table(table)


def point(spark: SparkSession, table: str, base: str) -> None:
    """Point the table's name at the newest version of its log."""
    log = version_log(spark, table, base)
    newest = log.entry(log.latest())
    _register(spark, newest)
    query = f"SELECT * FROM {newest['snapshot']}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER VIEW {table} AS {query}")
        spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ('comment' = '{_quoted(newest['comment'])}')")
    else:
        spark.sql(f"CREATE VIEW IF NOT EXISTS {table} COMMENT '{_quoted(newest['comment'])}' AS {query}")


def _register(spark: SparkSession, entry: dict) -> None:
    """Enter a version into this session's catalogue, which may have been started after it was written."""
    if spark.catalog.tableExists(entry["snapshot"]):
        return
    key, count = entry["key"], entry["buckets"]
    buckets = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {count} BUCKETS" if key else ""
    spark.sql(f"CREATE TABLE {entry['snapshot']} ({entry['schema']}) USING parquet {buckets} LOCATION '{_quoted(entry['location'])}'")


def _retain(spark: SparkSession, table: str, base: str, retain: int) -> None:
    """Forget all but the newest versions, the log entry first: an interrupted clean-up leaves no dangling version."""
    log = version_log(spark, table, base)
    for version in log.versions()[: -max(retain, 1)]:
        entry = log.entry(version)
        log.forget(version)
        spark.sql(f"DROP TABLE IF EXISTS {entry['snapshot']}")
        log.files.delete(entry["location"])


def remove_orphans(spark: SparkSession, table: str, base: str) -> list[str]:
    """Delete the folders that writers left behind before they added a version. Not while a refresh is under way."""
    log = version_log(spark, table, base)
    named = {entry["location"].rsplit("/", 1)[1] for entry in log.entries().values()}
    orphans = [n for n in SharedFiles(spark).names(_home(table, base)) if n.startswith("snapshot-") and n not in named]
    for name in orphans:
        log.files.delete(f"{_home(table, base)}/{name}")
    return orphans


def table_at(spark: SparkSession, table: str, base: str, version: int) -> DataFrame:
    """The rows of one version, bucketed as they were written."""
    entry = version_log(spark, table, base).entry(version)
    _register(spark, entry)
    return spark.table(entry["snapshot"])


def table_feed(spark: SparkSession, table: str, base: str, old: int, new: int, key: str) -> DataFrame:
    """The row-level changes that lead from one version of a table to another."""
    return snapshot_diff(table_at(spark, table, base, old), table_at(spark, table, base, new), key)


def history(spark: SparkSession, table: str, base: str) -> DataFrame:
    """(version, location, columns) of the retained versions."""
    entries = version_log(spark, table, base).entries()
    rows = [(v, e["location"], e["schema"]) for v, e in entries.items()]
    return spark.createDataFrame(rows, "version int, location string, columns string")


def manifest(spark: SparkSession, database: str, tables: list[str]) -> DataFrame:
    """Name, comment, column count and rows of published tables."""
    described = {table.name: table.description for table in spark.catalog.listTables(database)}
    rows = None
    for name in tables:
        frame = spark.table(f"{database}.{name}")
        counted = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(described.get(name)).cast("string").alias("comment"),
            F.lit(len(frame.columns)).alias("column_count"),
            "row_count",
        )
        rows = counted if rows is None else rows.unionByName(counted)
    return rows
