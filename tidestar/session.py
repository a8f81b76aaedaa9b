"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


LOCAL_MASTER = re.compile(r"local(\[|$)")  # driver and tasks in one process


def build_session(app: str = "tidestar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested with.

    Nothing here is needed on a cluster that already has a session: every
    function of the library takes the session it is given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        # Call sites of every column expression double the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.parquet.compression.codec": "snappy",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may lack it; a temporary folder is made then. On a
    cluster every executor would write to its own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not LOCAL_MASTER.match(context.master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share; the master is {context.master}")
        root = "file:" + tempfile.mkdtemp(prefix="tidestar-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"tidestar-{label}-{uuid.uuid4().hex[:12]}")
