"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on; all may be changed on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The size of a missing array is unknown, not -1.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.sizeOfNull": "false",
    # A repeated key in a JSON object keeps its last value, as in the common JSON libraries.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Shuffle files else stay until the driver happens to collect its garbage.
DROP_SHUFFLES = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def build_session(app_name: str = "demandlake", **conf: str) -> SparkSession:
    """A session with this package's settings; master and memory come from the deployment."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Steps run within leave no shuffle files: those of a step go when it ends.

    For a session that one thread works with. A stream has a session of its own, which may keep the setting.
    """
    name, value = DROP_SHUFFLES
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`.

    Where it is unset, a temporary folder takes its place if driver and executors are one process; on a
    cluster that is an error, as executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="demandlake-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared one."""
    return f"{shared_dir(spark)}/demandlake/{label}-{uuid.uuid4().hex}"
