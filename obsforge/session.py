"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "obsforge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator relies on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder: there the driver is the only machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="obsforge-")
    return _LOCAL_DIRS[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; two calls never collide."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Below so many bytes per core a table is spread over all cores; above, its files split into enough tasks by themselves.
SPREAD_BYTES = 128 << 20


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer expects the table to hold; for files their size, without listing them on the driver."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Repartition a table too small to split into a task per core; anything larger stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * SPREAD_BYTES else df


def written(df: DataFrame, name: str) -> DataFrame:
    """A durable copy in the shared folder: later passes read only the columns they need, and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that this application wrote as an intermediate step."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not an intermediate table")
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike a local one."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark) + "/checkpoints")
    return df.checkpoint(eager=True)


METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def compiled_methods(spark: SparkSession) -> None:
    """Have Spark split generated code that the JVM would never compile: it only interprets methods of more than 8,000 bytes.

    Rules and preparations of many columns are that long, and take ten times as long then. Results do not depend on it. A lower
    limit that the session has already is kept.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > METHOD_BYTES:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


# Folders that one task keeps open at a time when it writes a partitioned table; the rows of further ones are sorted.
OPEN_FOLDERS = 4
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Within it, a table of a few folders is written as its rows come: else each task sorts them by folder, and spills."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)
