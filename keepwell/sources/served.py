"""A stored copy of a table that is kept in step with its source by applying change feeds.

The copy's rows lie in buckets of their key. A version of the copy names one folder for each bucket, and which version
of the source it shows. Applying a feed rewrites only the buckets that hold a changed key and names the
old folders for the others. Rows and the applied source version become visible in the same instant, so
after a crash the same feed is applied to the same rows again, and a second writer is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keepwell.operators.sync import BEFORE, CHANGE, snapshot_diff, upsert_merge
from keepwell.sources.tables import table_at, version_log
from keepwell.sources.versions import VersionLog

BUCKET = "_bucket"
RETAINED = 3


class ServedCopy:
    """buckets: fixed when the copy is made, by default the shuffle's partitions; one task rewrites a bucket."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int | None = None):
        self.spark, self.base, self.key = spark, base.rstrip("/"), key
        self.log = VersionLog(spark, f"{self.base}/_log")
        newest = self.log.latest()
        self.buckets = self.log.entry(newest)["buckets"] if newest else buckets or int(
            spark.conf.get("spark.sql.shuffle.partitions")
        )

    @property
    def applied(self) -> int:
        """The source's version that the copy shows, 0 before the first."""
        newest = self.log.latest()
        return self.log.entry(newest)["source_version"] if newest else 0

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, entry: dict, buckets: set[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        folders = [f"{self.base}/{at}" for b, at in sorted(entry["folders"].items()) if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # columns added after a bucket was written read as NULL
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.log.entry(version or self.log.latest()))

    def _store(self, df: DataFrame) -> dict[str, str]:
        """Write rows into new bucket folders; the folder of each bucket that has rows."""
        run = f"data/{uuid.uuid4().hex}"
        placed = df.withColumn(BUCKET, self._bucket()).repartition(BUCKET).sortWithinPartitions(BUCKET, self.key)
        placed.write.partitionBy(BUCKET).parquet(f"{self.base}/{run}")
        names = self.log.files.names(f"{self.base}/{run}")
        return {n.split("=")[1]: f"{run}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def replace(self, df: DataFrame, source_version: int) -> int:
        """Make df the whole content."""
        after = self.log.latest()
        folders = self._store(df)
        return self._commit(folders, df.schema, source_version, after)

    def merge(self, feed: DataFrame, source_version: int) -> int:
        """Apply a change feed. Buckets without a changed key keep their files."""
        after = self.log.latest()
        entry = self.log.entry(after)
        final = feed.filter(F.col(CHANGE) != BEFORE)
        touched = {str(r[0]) for r in final.select(self._bucket()).distinct().collect()}  # at most one for each bucket
        if not touched:
            return self._commit(entry["folders"], StructType.fromJson(entry["schema"]), source_version, after)
        merged = upsert_merge(self._rows(entry, touched), feed, self.key)
        kept = {b: at for b, at in entry["folders"].items() if b not in touched}
        return self._commit(kept | self._store(merged), merged.schema, source_version, after)

    def _commit(self, folders: dict[str, str], schema: StructType, source_version: int, after: int) -> int:
        entry = {
            "folders": folders, "schema": schema.jsonValue(), "source_version": source_version, "buckets": self.buckets, "key": self.key,
        }
        return self.log.commit(entry, after)

    def changes(self, old: int, new: int) -> DataFrame:
        """The feed between two versions of the copy; buckets that share their files are not read."""
        first, second = self.log.entry(old), self.log.entry(new)
        differ = {b for b in {*first["folders"], *second["folders"]} if first["folders"].get(b) != second["folders"].get(b)}
        return snapshot_diff(self._rows(first, differ), self._rows(second, differ), self.key)

    def retain(self, versions: int = RETAINED) -> None:
        """Forget older versions, then delete the bucket folders that no version names any more."""
        old = self.log.versions()[: -max(versions, 1)]
        gone = {at for v in old for at in self.log.entry(v)["folders"].values()}
        for version in old:
            self.log.forget(version)
        held = {at for entry in self.log.entries().values() for at in entry["folders"].values()}
        for at in sorted(gone - held):
            self.log.files.delete(f"{self.base}/{at}")


def sync(spark: SparkSession, table: str, base: str, copy: ServedCopy) -> int:
    """Bring the copy to the newest version of a published table; the applied source version.

    Starts from the version that the copy shows, so syncs follow each other without gaps whatever
    happened in between. If that version is no longer retained, the copy is written anew.
    """
    log = version_log(spark, table, base)
    newest, applied = log.latest(), copy.applied
    if newest == applied:
        return applied
    if applied in log.versions():
        feed = snapshot_diff(table_at(spark, table, base, applied), table_at(spark, table, base, newest), copy.key)
        stored = f"{copy.base}/feeds/{uuid.uuid4().hex}"  # both snapshots are read once for it
        feed.write.parquet(stored)
        copy.merge(spark.read.schema(feed.schema).parquet(stored), newest)
        copy.log.files.delete(stored)
    else:
        copy.replace(table_at(spark, table, base, newest), newest)
    copy.retain()
    return newest
