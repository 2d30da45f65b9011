"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, base: str | None = None) -> str:
    """A new directory name in a folder that driver and executors share.

    That is ``base``, else the session's checkpoint folder, set by ``setCheckpointDir`` or in
    ``spark.checkpoint.dir``. Without any of them a local session, whose tasks all run on
    this machine, gets a temporary folder; on a cluster that is an error.
    """
    context = spark.sparkContext
    base = base or context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("name a shared folder: set spark.checkpoint.dir or pass one")
        base = tempfile.mkdtemp(prefix="sievework-")
    return f"{base.rstrip('/')}/sievework-{uuid.uuid4().hex}"
