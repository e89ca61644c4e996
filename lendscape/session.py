"""Session defaults and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Seventy-column projections generate methods beyond 8000 bytes, which the JVM
# by default never compiles: they run several times slower. A cluster should
# start driver and executors with this flag (spark.*.extraJavaOptions).
JVM_FLAG = "-XX:-DontCompileHugeMethods"
# Where it is absent, this limit makes Spark split such methods instead.
METHOD_LIMIT, DEFAULT_LIMIT, COMPILED_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Keep wide projections compiled on a session started without the JVM flag."""
    options = " ".join(
        spark.conf.get(f"spark.{side}.extraJavaOptions", None) or "" for side in ("driver", "executor")
    )
    if JVM_FLAG not in options and spark.conf.get(METHOD_LIMIT, DEFAULT_LIMIT) == DEFAULT_LIMIT:
        spark.conf.set(METHOD_LIMIT, COMPILED_LIMIT)
    return spark


def local_session(
    app: str = "lendscape", cores: int | str = "*", partitions: int = 8, compile_huge: bool = True
) -> SparkSession:
    """Session for tests and the bench; a cluster supplies its own.

    Compiling huge methods pays off in jobs of minutes, splitting them in jobs
    of seconds, which end before the compiler is done.
    """
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", JVM_FLAG if compile_huge else "")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster
    other machines could not read what one of them wrote there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="lendscape-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, freezes
    non-deterministic columns, and gives the optimizer the real size, so that
    Spark itself decides between a broadcast and a shuffled join.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    for paths in getattr(_open, "passing", []):
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_open = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What :func:`keep` writes inside is deleted at the end: nothing may read it later."""
    stack = _open.__dict__.setdefault("passing", [])
    stack.append(paths := [])
    try:
        yield
    finally:
        stack.pop()
        discard(spark, *paths)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders of this library's own making."""
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have shuffle files deleted that no plan refers to: Spark does so after the driver's heap was collected, which may take very long."""
    gc.collect()  # frames of Python hold plans of the JVM
    spark.sparkContext._jvm.System.gc()
