"""Where intermediate tables live, and how lineage is cut.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """Shared folder for written tables; also sets the checkpoint folder where none is set."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="passagerank-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/passagerank-{sc.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    workspace(df.sparkSession)
    return df.checkpoint(eager=True)
