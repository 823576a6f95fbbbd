"""Session settings the engine relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` that all executors reach, under ``spark.checkpoint.dir``.

    Where that is unset, a session whose tasks run in this one process (``local[...]``) gets a temporary folder; on any
    other master a folder of one machine would lose rows, so this raises.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="tallyloom-")
        named = _LOCAL[context.applicationId]
    return f"{named.rstrip('/')}/{context.applicationId}/{purpose}/{uuid.uuid4().hex}"
