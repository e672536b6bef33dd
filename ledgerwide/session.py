"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerwide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of files that a task of a load reads at most, and of shuffled rows where adaptive execution
#: chooses. Rows of statements take some 5 bytes in Parquet and 25 shuffled, but 300 in a sort or
#: hash table, so Spark's own 128 and 64 MB would fill gigabytes there.
LOAD_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


@contextmanager
def bounded_tasks(spark: SparkSession, settings: Mapping[str, int] | None = None) -> Iterator[None]:
    """Smaller tasks for what is planned inside the block; smaller sizes that are set already stay."""
    before = {name: spark.conf.get(name) for name in settings or LOAD_BYTES}
    try:
        for name, most in (settings or LOAD_BYTES).items():
            if _bytes(spark, before[name]) > most:
                spark.conf.set(name, f"{most}b")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark reads it, as ``64MB`` or a plain number of bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only when that setting is absent (local tests) is a temporary folder made,
    and only a local master may use one: on a cluster it would not be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerwide-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder this module named, once nothing reads it any more."""
    if not path.startswith(scratch_root(spark).rstrip("/") + "/"):
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
