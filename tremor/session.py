"""Session helpers shared by operators, queries, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", partitions: int = 8, app: str = "tremor") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for stored tables, within the folder of checkpoints.

    That is the cluster's shared one in ``spark.checkpoint.dir``. Only in local mode,
    where it is unset (tests, a laptop), a local folder is made; on a cluster that is
    an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tremor-ckpt-"))
    return f"{sc._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession, "")
    return df.checkpoint()
