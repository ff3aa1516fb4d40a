"""Session settings the operators rely on, and the shared folder for job state."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Logged wall-clock times are stored as they stand, so the session must not shift them.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the month partitions (and batch ids) that a write touches are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Folders made for local sessions that name none, by application.
OWN_ROOTS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may name none; it gets a folder of
    its own for as long as it lives.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in OWN_ROOTS:
        OWN_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return OWN_ROOTS[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
