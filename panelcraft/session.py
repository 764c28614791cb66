"""Session helpers: a fault-tolerant lineage cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: on a
    cluster a machine-local path would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            shared = tempfile.mkdtemp(prefix="panelcraft-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later plans start from the stored rows, so what is decided from one read
    (such as partition numbers) holds for every other, whatever is lost and
    recomputed in between; and they read only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
