"""Change feed between snapshots, keyed sync, verification and table discovery."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"
CHANGE = "_change_type"
# Marks the catalogue's names of single versions of a table.
SNAPSHOT = "__snapshot_"


def _wrapped(df: DataFrame, key: str, name: str) -> DataFrame:
    """key plus the whole row as one struct, so two versions compare with one null-safe test."""
    return df.select(key, F.struct(*df.columns).alias(name))


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """df with NULL for the columns that only the other frame has, after its own."""
    more = [f for f in other.schema.fields if f.name not in df.columns and f.name != CHANGE]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more}) if more else df


def _paired(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Both versions of each row over the columns of either: an added or dropped column is a change, too."""
    old = _with_columns_of(old, new)
    new = _with_columns_of(new, old).select(*old.columns)
    return _wrapped(old, key, "__old").join(_wrapped(new, key, "__new"), key, "full")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Row-level changes from old to new in one full outer join on the key.

    An update yields its row before and after; unchanged rows yield nothing.
    """
    gone, came = F.col("__new").isNull(), F.col("__old").isNull()

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias(CHANGE), F.col(row).alias("row"))

    changes = (
        F.when(came, F.array(change(INSERT, "__new")))
        .when(gone, F.array(change(DELETE, "__old")))
        .otherwise(F.array(change(BEFORE, "__old"), change(AFTER, "__new")))
    )
    return (
        _paired(old, new, key)
        .filter(~F.col("__old").eqNullSafe(F.col("__new")))
        .select(F.explode(changes).alias("change"))
        .select("change.row.*", f"change.{CHANGE}")
    )


def upsert_merge(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The target with a change feed applied: inserts and updates win, deletes go.

    Applying the same feed twice gives the same rows. Columns that only the feed has are added.
    """
    target = _with_columns_of(target, changes)
    final = changes.filter(F.col(CHANGE) != BEFORE)
    latest = final.select(key, F.struct(*target.columns).alias("__new"), CHANGE)
    kept = F.coalesce(F.col(CHANGE) != DELETE, F.lit(True))
    row = F.when(F.col(CHANGE).isNotNull(), F.col("__new")).otherwise(F.col("__old"))
    return (
        _wrapped(target, key, "__old")
        .join(latest, key, "full")
        .filter(kept)
        .select(row.alias("row"))
        .select("row.*")
    )


def sync_check(source: DataFrame, target: DataFrame, key: str, name: str) -> DataFrame:
    """One row: counts on both sides, keys missing on either, rows that differ."""
    has_source, has_target = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    counted = _paired(source, target, key).agg(
        F.count_if(has_source).alias("source_rows"),
        F.count_if(has_target).alias("target_rows"),
        F.count_if(has_source & ~has_target).alias("missing_rows"),
        F.count_if(~has_source & has_target).alias("extra_rows"),
        F.count_if(has_source & has_target & ~F.col("__old").eqNullSafe(F.col("__new"))).alias("different_rows"),
    )
    clean = (F.col("missing_rows") + F.col("extra_rows") + F.col("different_rows")) == 0
    return counted.select(F.lit(name).alias("table_name"), "*", clean.alias("in_sync"))


def sync_checks(pairs: Sequence[tuple[str, DataFrame, DataFrame]], key: str = "customer_id") -> DataFrame:
    return reduce(DataFrame.unionByName, [sync_check(s, t, key, name) for name, s, t in pairs])


def describe(df: DataFrame, name: str) -> DataFrame:
    """Columns with type and nullability, and how many values each really has."""
    filled = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(field.nullable).alias("is_nullable"),
            (F.col("__rows") - F.col(f"`{field.name}`")).alias("null_values"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return filled.select(F.inline(F.array(*rows)))


def matching_tables(spark: SparkSession, keywords: Sequence[str], database: str) -> list[str]:
    """Names of catalogue tables that contain any keyword; single versions of a table are not listed."""
    lowered = [word.lower() for word in keywords]
    names = (table.name for table in spark.catalog.listTables(database))
    return sorted(name for name in names if SNAPSHOT not in name and any(word in name.lower() for word in lowered))
