"""Where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path in the folder of ``spark.checkpoint.dir``, which every executor can reach.

    A temporary folder of this machine is used only in local mode without that setting.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="txmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
