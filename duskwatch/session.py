"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Read by Spark at run time, so they can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC) and what skew handling depends on (AQE)."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A private one is made only where the setting is absent, as in a local test.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="duskwatch-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_MADE: list[str] = []


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/duskwatch/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote; frames still reading them become invalid.

    Call it at the end of a job, when its results are stored. Returns how many were deleted.
    """
    done = len(_MADE)
    while _MADE:
        delete_path(spark, _MADE.pop())
    return done


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. ``by`` lays it out in one folder per value.

    Used where one result feeds several jobs: the lineage is cut by a durable
    table, so a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a materialized table that nothing reads any more."""
    files = df.inputFiles()
    for path in [p for p in _MADE if files and f"/{p.rpartition('/')[2]}/" in files[0]]:
        delete_path(df.sparkSession, path)
        _MADE.remove(path)
