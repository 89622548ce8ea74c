"""Session helper, shared work folder and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "lakeloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakeloom-wh-"),
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Runtime settings the operators count on; sizes and parallelism stay the cluster's own."""
    for key in ("adaptive.enabled", "adaptive.skewJoin.enabled", "adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.{key}", "true")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset
    and everything runs in one process (tests) is a folder of our own chosen,
    once per application; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = context.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="lakeloom-shared-")
        path = _own_dirs[app]
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder, kept per application."""
    path = f"{_app_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _scopes:
        paths.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The paths that are staged inside the block, for ``drop``."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes[:] = [s for s in _scopes if s is not paths]


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Everything staged inside the block is deleted at its end; write or collect results before."""
    with collecting() as paths:
        try:
            yield paths
        finally:
            drop(spark, paths)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged paths that no DataFrame needs any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lakeloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> bool:
    """Delete what this application staged; call it when no DataFrame is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_app_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage in a way that survives losing executors, fixes values that
    must not be computed twice, and gives later joins real file statistics.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
