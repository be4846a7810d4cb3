"""Shared-folder helpers: where intermediate tables go and how lineage is cut."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names in ``spark.checkpoint.dir``.

    A local folder is made only where that setting is absent, as in a test session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL_BASE:
        _LOCAL_BASE["dir"] = tempfile.mkdtemp(prefix="tickloom-")
        atexit.register(shutil.rmtree, _LOCAL_BASE["dir"], ignore_errors=True)
    return _LOCAL_BASE["dir"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing exists there yet."""
    return f"{_session_root(spark)}/{label}-{uuid.uuid4().hex}"


def _session_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tickloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete every table this application has put in the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    For small results of a large scan that several branches of a plan read, and for rows whose
    physical placement must not change between two passes. A lost executor costs a re-read of the
    written files, not a recomputation, and the read side has file statistics for join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a plain scan, over all cores when its files have fewer splits than there are cores.

    For steps that spend far more time per row than a scan. A large table has more splits than cores
    and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
