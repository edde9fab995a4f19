"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH_BYTES = f"{64 << 20}b"
_STAGE_BATCH_BYTES = 8 << 20


def build_session(app_name: str = "mailrisk", master: str | None = None, **settings) -> SparkSession:
    """Session with adaptive execution; cluster submitters leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_with_tasks(module: str) -> None:
    """Send the functions of a module along with tasks, so that executors need
    no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine, so that is refused.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="mailrisk-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for one written intermediate table."""
    return f"{shared_folder(spark)}/mailrisk/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most 8 MB for what is run inside: by default a task
    holds ten thousand texts, or 64 MB, on both sides of the pipe to Python. A
    setting of the user's own stays."""
    before = spark.conf.get(BATCH_BYTES, _DEFAULT_BATCH_BYTES)
    if before != _DEFAULT_BATCH_BYTES:
        yield
        return
    spark.conf.set(BATCH_BYTES, f"{_STAGE_BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


@dataclass(frozen=True)
class Stage:
    """A written intermediate table and the folder that holds it."""

    rows: DataFrame
    path: str

    def remove(self) -> None:
        """Delete the folder; call it once nothing lazy reads ``rows`` any more."""
        spark = self.rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_stage(df: DataFrame, name: str, schema=None) -> Stage:
    """Write ``df`` once; reading it back cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return Stage(spark.read.schema(schema or df.schema).parquet(path), path)


def write_stage(df: DataFrame, name: str, schema=None) -> DataFrame:
    """``new_stage`` for a table that the result reads, so that it has to stay."""
    return new_stage(df, name, schema).rows
