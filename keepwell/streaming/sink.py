"""A table fed by micro-batches, each of which is stored once whatever happens, with its figures.

A batch is written aside and takes its place by one renaming, so a place holds a whole batch or does not
exist. Its figures follow as a small file of the same name. A batch that is handed over again, because the driver
died before the stream took note of it, finds its place taken and is not stored a second time; if its
figures are missing they are counted again from the same rows. Batches with different schemas lie in different
folders and are read together under the widest one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keepwell.session import shuffles_freed
from keepwell.sources.files import SharedFiles
from keepwell.streaming.schemas import conformed, merged

FIGURES = "name string, figures map<string, bigint>"


class BatchSink:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.files = SharedFiles(spark)

    def write(
        self, df: DataFrame, name: str, figures: Mapping[str, Column], keep: Callable[[DataFrame], DataFrame] = lambda df: df
    ) -> None:
        """Store keep(df) as the batch of this name, and the figures counted over df in the same pass."""
        note = f"{self.base}/_figures/{name}.json"
        if self.files.exists(note):
            return
        columns = [column.alias(figure) for figure, column in figures.items()]
        stored = keep(df)
        group = hashlib.md5(stored.schema.json().encode()).hexdigest()[:12]
        folder = f"{self.base}/data/{group}"
        if self.files.exists(f"{folder}/{name}"):
            counted = df.agg(*columns).first().asDict()
        else:
            self.files.write_new(f"{folder}/_schema", stored.schema.json())
            aside = f"{self.base}/_aside/{uuid.uuid4().hex}"
            seen = Observation()
            with shuffles_freed(df.sparkSession):
                keep(df.observe(seen, *columns)).write.option("compression", "zstd").parquet(aside)
            counted = seen.get
            self.files.rename(aside, f"{folder}/{name}")
        self.files.write_new(note, json.dumps({"name": name, "figures": counted}))

    def schemas(self) -> dict[str, StructType]:
        """The schema of each folder, in order of first use."""
        folders = [(when, name) for name, _, when in self.files.listing(f"{self.base}/data")]
        read = lambda name: StructType.fromJson(json.loads(self.files.read(f"{self.base}/data/{name}/_schema")))
        return {name: read(name) for _, name in sorted(folders)}

    def batches(self) -> list[str]:
        """Names of the stored batches."""
        return sorted(n for group in self.schemas() for n in self._names(group))

    def _names(self, group: str) -> list[str]:
        return [n for n in self.files.names(f"{self.base}/data/{group}") if not n.startswith("_")]

    def read(self, without: Collection[str] = ()) -> DataFrame | None:
        """All stored rows under the widest schema; None if there is no batch but those left out."""
        folders: dict[str, list[str]] = {}
        schemas = self.schemas()
        for group in schemas:
            place = f"{self.base}/data/{group}"
            if not without:
                folders[group] = [place]
            elif held := [f"{place}/{n}" for n in self._names(group) if n not in without]:
                folders[group] = held
        if not folders:
            return None
        wide = merged(schemas[group] for group in folders)
        reader = self.spark.read.option("recursiveFileLookup", "true")
        parts = [conformed(reader.schema(schemas[group]).parquet(*held), wide) for group, held in folders.items()]
        return reduce(DataFrame.unionByName, parts)

    def totals(self) -> dict[str, int]:
        """Every figure, added up over all batches ever stored."""
        if not self.files.names(f"{self.base}/_figures"):
            return {}
        notes = self.spark.read.schema(FIGURES).json(f"{self.base}/_figures")
        sums = notes.select(F.explode("figures").alias("figure", "n")).groupBy("figure").agg(F.sum("n").alias("n"))
        return {r.figure: r.n for r in sums.collect()}
