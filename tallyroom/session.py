"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles and splits hot partitions at run time;
# nothing here fixes a partition count, so a cluster's own value stands.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "tallyroom", master: str | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates and streaming checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a
    local-mode session may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = os.path.join(tempfile.gettempdir(), "tallyroom-scratch")
    os.makedirs(root, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
