"""Session settings and the shared scratch folder."""
from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job of this library wants. Anything sized to a cluster (memory, executors,
# initial shuffle partitions) is left to the submitter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    # tables are partitioned by kind and by validity: a few open files per task instead of a sort
    "spark.sql.maxConcurrentOutputFileWriters": "12",
}


_PACKAGE_ROOT = str(Path(__file__).resolve().parents[1])
_SCRATCH = re.compile(r"-[0-9a-f]{32}\Z")


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, as named by the cluster in spark.checkpoint.dir; where that is unset,
    one below the session's warehouse, which executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def time_ordered_id() -> str:
    """Unique text that sorts by creation time (nanoseconds since 1970 in 20 digits)."""
    return f"{time.time_ns():020d}-{uuid.uuid4()}"


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: reuse without recomputation,
    and lineage that survives lost executors."""
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, so that any store that Spark reads will do."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def delete_folder(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.delete(location, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    files, location = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(location) if status.isDirectory())


def expire_scratch(spark: SparkSession, older_than_s: float) -> list[str]:
    """Delete intermediate folders of the shared folder that were last written ``older_than_s`` ago or earlier, which must
    be longer than any run takes. Returns their names."""
    root = shared_folder(spark)
    files, location = _file_system(spark, root)
    if not files.exists(location):
        return []
    limit = (time.time() - older_than_s) * 1000
    old = [s for s in files.listStatus(location) if s.isDirectory() and s.getModificationTime() <= limit]
    # names made by scratch() end in a random identifier; others are not ours
    gone = [s.getPath().getName() for s in old if _SCRATCH.search(s.getPath().getName())]
    for name in gone:
        delete_folder(spark, f"{root}/{name}")
    return sorted(gone)


#: Bytes of an Arrow batch, in the JVM and in the Python worker, where the session has no value of its own.
BATCH_BYTES = 8 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)


def in_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with this package on the path of the Python workers: they find it where the driver does, also if
    the session was started elsewhere. (A cluster without a shared installation is given it by --py-files.)"""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_PACKAGE_ROOT, *filter(None, paths)])
    # several tasks' batches of texts are held at once, on both sides
    settings = df.sparkSession.conf
    if settings.get(_BATCH_SETTING, _BATCH_DEFAULT).rstrip("b") == _BATCH_DEFAULT:
        settings.set(_BATCH_SETTING, str(BATCH_BYTES))

    def released(batches):
        import pyarrow

        yield from function(batches)
        # workers wait for the next task with what they hold
        pyarrow.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a frame of literals: no Python workers are started for them."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    records = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))


def side_by_side(spark: SparkSession, *branches: Callable[[], object]) -> list:
    """Submit independent branches at once, so that small jobs share the cluster instead of queueing.
    All are waited for; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(branches)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(branch)) for branch in branches]
    return [r.result() for r in running]
