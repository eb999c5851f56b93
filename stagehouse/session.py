"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What the plans in this package count on. All are Spark defaults except the
# forced skew handling (AQE may add a shuffle to split a hot join key) and the
# session zone (every timestamp here is zone-free).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_scratch: dict[str, str] = {}
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def build_session(app: str = "stagehouse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each see a different one.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = sc.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="stagehouse-")
    return _local_scratch[app]


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/stagehouse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the scratch folder; nothing is created."""
    return f"{_job_folder.get() or _own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all this application has materialized, once its results are written."""
    delete(spark, _own_scratch(spark))


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was materialized inside.

    For jobs that leave their results in tables of their own. Threads started
    inside take part when they run in a copy of the context.
    """
    folder = scratch_path(spark, "job")
    token = _job_folder.set(folder)
    try:
        yield
    finally:
        _job_folder.reset(token)
        delete(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` with a parquet table in the shared folder.

    The read-back plan knows its true size, so Catalyst can decide on a
    broadcast from the files rather than from a guess, and a lost executor
    costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
