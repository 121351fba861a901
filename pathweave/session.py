"""The session settings that the engine needs, and lineage cuts for iterative operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from itertools import count

from pyspark.sql import DataFrame, SparkSession

#: Tag bags keep the last of repeated keys; timestamps are read in UTC.
REQUIRED = {"spark.sql.mapKeyDedupPolicy": "LAST_WIN", "spark.sql.session.timeZone": "UTC"}

#: Tables after which the driver's memory is collected.
COLLECT = 6
made = count(1)


def builder(app: str = "pathweave") -> SparkSession.Builder:
    out = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in REQUIRED.items():
        out = out.config(key, value)
    return out


def prepare(spark: SparkSession) -> SparkSession:
    """Set what must hold on a session that someone else built."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. A temporary folder stands in for it only in local mode, where
    driver and executors are one process; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt"))
    return sc.getCheckpointDir()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside; what held before holds again afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Delete a folder of the shared store, now or when the application ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.deleteOnExit(place) if at_exit else store.delete(place, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, for files of this application; it goes when that ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    delete(spark, path, at_exit=True)
    return path


def collect_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage and give freed memory back to the system.

    Hundreds of small plans would have its heap grow to the limit first; Spark's cleaner, too, drops
    broadcasts and shuffles only when the heap is collected.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with the lineage cut: a table in the shared checkpoint folder.

    A lost executor costs nothing, as any other can read the table. Shuffle files of the plan go as
    soon as the table is written; the table goes with forget() or when the application ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    if next(made) % COLLECT == 0:
        collect_driver(spark)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the tables behind frames that cut() made and that nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df.cut_path)
