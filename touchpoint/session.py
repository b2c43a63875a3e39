"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "touchpoint", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, wherever the session was started from. Once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="touchpoint-code-"), "touchpoint_code")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are compared and printed in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Bytes of an Arrow batch. A task holds a batch in the JVM and again in Python, and 10,000 whole texts can be long.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> SparkSession:
    """Python tasks get their rows in batches of bounded bytes, whatever the length of a text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path for intermediate tables, in the folder the cluster shares.

    The folder is ``spark.checkpoint.dir``. Only a local session may go without it; there a
    temporary folder is as good, since every task runs on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="touchpoint-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
