"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# AQE merges small shuffle partitions, splits a partition that one hot key has filled, and turns a join into a broadcast join only
# once the measured side is below the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_scratch_roots: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Staged data must be readable by every executor and outlive any of them, so a machine-local
    folder is only used where the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _scratch_roots.get(context.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="lodgestar-")
            _scratch_roots[context.applicationId] = root
    return f"{root.rstrip('/')}/lodgestar/{name}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: what is used several times is computed once.

    The written files also cut the lineage, so losing an executor later costs no recomputation.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def run_together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Results of independent Spark actions, submitted at once.

    While the last tasks of one write run, the others use the free slots. The first error is raised
    after all have ended.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        pending = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [future.result() for future in pending]
