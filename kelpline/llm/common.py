"""Helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most 64 bytes that may be broadcast (32 MB); more rows take a shuffle join.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset (tests, local runs) a temporary folder is made.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not configured:
        configured = f"file://{tempfile.mkdtemp(prefix='kelpline-')}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _hadoop_path(spark, path)
    fs.delete(where, True)


def publish(spark: SparkSession, text: str, place: str) -> bool:
    """Creates the file ``place`` with ``text`` at once; false if it is there already.

    One of several writers succeeds: a file's rename onto another fails on HDFS, a
    hard link to a name that exists fails on local disks. Stores without an atomic
    rename (plain object stores) need one writer at a time.
    """
    target, fs = _hadoop_path(spark, place)
    draft, _ = _hadoop_path(spark, f"{place}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(target) and fs.rename(draft, target)
        jvm = spark.sparkContext._jvm
        local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
        jvm.java.nio.file.Files.createLink(*local)
        return True
    except Py4JJavaError as problem:
        if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)


def content(spark: SparkSession, place: str) -> str:
    where, fs = _hadoop_path(spark, place)
    source = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _hadoop_path(spark, path)
    return fs.exists(where)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/kelpline-{label}-{uuid.uuid4().hex}"

    def clean() -> None:
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            remove(spark, path)

    atexit.register(clean)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where a count shows at most ``bound`` rows; else the frame as it is."""
    return F.broadcast(df) if df.count() <= bound else df


@contextmanager
def batch_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Python gets at most ``most`` rows at once from what is run inside: for rows that are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
