"""Registered model runs, and the one whose scores are deployed.

Runs are only ever added. Deploying a run stores its scores as a draft, checks that, publishes it as the next version
of one table and then points at run and version in one entry, so whoever asks for the current scores gets those of
one run, complete; earlier deployments stay known and can be returned to.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.sources.tables import publish, table_at, version_log
from keepwell.sources.versions import VersionLog

RUNS = "run int, model string, path string, metrics map<string, double>"
RETAINED = 10


class BadScores(ValueError):
    """Scores that must not be deployed."""


class ModelRegistry:
    def __init__(self, spark: SparkSession, base: str, table: str, key: str = "customer_id", score: str = "churn_score"):
        self.spark, self.base, self.table, self.key, self.score = spark, base.rstrip("/"), table, key, score
        self._runs = VersionLog(spark, f"{self.base}/_runs")
        self._deployed = VersionLog(spark, f"{self.base}/_deployed")

    def register(self, model: str, path: str, metrics: dict[str, float]) -> int:
        """Add a run; its number."""
        return self._runs.commit({"model": model, "path": path, "metrics": metrics}, self._runs.latest())

    def runs(self) -> DataFrame:
        rows = [(n, e["model"], e["path"], e["metrics"]) for n, e in self._runs.entries().items()]
        return self.spark.createDataFrame(rows, RUNS)

    def best(self, metric: str) -> int:
        """The run with the largest value of a metric, the first one on a tie."""
        return max(self._runs.entries().items(), key=lambda item: (item[1]["metrics"].get(metric, float("-inf")), -item[0]))[0]

    def model(self, run: int) -> PipelineModel:
        return PipelineModel.load(self._runs.entry(run)["path"])

    def deploy(self, run: int, scores: DataFrame, customers: DataFrame) -> int:
        """Publish a run's scores, one row in 0..100 for every customer and none else; the table's version."""
        self._runs.entry(run)
        drafts = f"{self.base}/_drafts/{uuid.uuid4().hex}"
        scores.write.parquet(drafts)
        try:
            draft = self.spark.read.schema(scores.schema).parquet(drafts)
            told = self._check(draft, customers)
            if told:
                raise BadScores(told)
            after = version_log(self.spark, self.table, self.base).latest()
            publish(draft, self.table, self.base, f"Scores of model run {run}", self.key, after=after, retain=RETAINED)
            version = after + 1
        finally:
            self._runs.files.delete(drafts)
        self._deployed.commit({"run": run, "version": version}, self._deployed.latest())
        return version

    def _check(self, scores: DataFrame, customers: DataFrame) -> str:
        """What is wrong with scores, in words; nothing if they may be deployed."""
        held = scores.groupBy(self.key).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col(self.score).between(0, 100), F.lit(False))).alias("off")
        )
        wanted = customers.select(F.col(self.key)).distinct().withColumn("wanted", F.lit(True))
        found = held.join(wanted, self.key, "full").agg(
            F.count_if(F.col("n") > 1).alias("repeated"), F.coalesce(F.sum("off"), F.lit(0)).alias("out of range"),
            F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("wanted").isNull()).alias("unknown"),
        )
        return ", ".join(f"{n} {what}" for what, n in found.first().asDict().items() if n)

    def current(self) -> dict[str, Any] | None:
        """Run and table version that are deployed."""
        newest = self._deployed.latest()
        return self._deployed.entry(newest) if newest else None

    def at(self, version: int) -> DataFrame:
        return table_at(self.spark, self.table, self.base, version)

    def scores(self) -> DataFrame:
        """The deployed scores."""
        return self.at(self.current()["version"])

    def roll_back(self) -> dict[str, Any]:
        """Return to the deployment before; what is deployed then."""
        entries = self._deployed.entries()
        newest = max(entries)
        before = [e for n, e in sorted(entries.items()) if e["version"] < entries[newest]["version"]]
        if not before:
            raise LookupError("nothing was deployed before")
        self._deployed.commit(before[-1], newest)
        return before[-1]
