"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Declarative settings only; executor counts and memory belong to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "keepwell", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the one submitted with the job."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where nothing is configured, one machine (tests) makes a temporary folder; a cluster uses the
    warehouse if that was set, since its default is a path on the driver's own disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        made = tempfile.mkdtemp(prefix="keepwell-")
    elif not context.getConf().contains("spark.sql.warehouse.dir"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    else:
        made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    context.setCheckpointDir(made)
    return context.getCheckpointDir()


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
