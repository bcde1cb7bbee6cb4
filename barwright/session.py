"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# UTC keeps dates free of zone shifts. AQE does the run-time work: it picks broadcast joins from
# measured sizes, merges small shuffle partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet unfolds in memory: plan broadcasts from a multiple of the file size.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

_LOCAL_SCRATCH = "spark.barwright.localScratch"


def sizing(input_bytes: int, task_bytes: int = 2**30) -> dict[str, str]:
    """Settings for a job over ``input_bytes``: about ``task_bytes`` a reduce task before AQE merges
    small ones. Every map task keeps an entry for each; raise ``task_bytes`` if those get too many."""
    tasks = max(input_bytes // task_bytes, 200)
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def build_session(app: str = "barwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Every executor must see what is written here, so a machine-local folder is used only when the
    setting is absent and Spark itself runs on one machine. What is there when this process ends is
    removed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_SCRATCH, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="barwright-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set(_LOCAL_SCRATCH, base)
    path = f"{base.rstrip('/')}/barwright/{label}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Results are lazy and read their folders as long as this process lives, and no longer."""
    folder, settings = _folder(spark, path)

    def clean() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone before
            folder.getFileSystem(settings).delete(folder, True)

    atexit.register(clean)


@contextlib.contextmanager
def staged(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """``rows`` written once to the shared folder and read back, for use more than once.

    Later steps read files and not the plan behind them, also after executors are lost. The folder
    is removed on leaving.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    _hadoop_path(spark, path, lambda fs, folder: fs.delete(folder, True))


def rename(spark: SparkSession, path: str, to: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if not _hadoop_path(spark, path, lambda fs, folder: fs.rename(folder, target)):
        raise OSError(f"{path} could not be renamed to {to}")


def path_exists(spark: SparkSession, path: str) -> bool:
    return _hadoop_path(spark, path, lambda fs, folder: fs.exists(folder))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it does not exist."""
    return file_names(spark, path)


def file_names(spark: SparkSession, path: str) -> list[str]:
    def names(fs, folder):
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return _hadoop_path(spark, path, names)


def read_text(spark: SparkSession, path: str) -> str:
    def read(fs, file):
        stream = fs.open(file)
        try:
            return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
    return _hadoop_path(spark, path, read)


def place_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path``, whole or not at all; False if there is one already, also if somebody
    else makes it at the same time."""
    def place(fs, file):
        ready = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(ready, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            if fs.makeQualified(file).toUri().getScheme() != "file":
                return not fs.exists(file) and fs.rename(ready, file)
            os.link(ready.toUri().getPath(), file.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(ready, False)
    return _hadoop_path(spark, path, place)


def _hadoop_path(spark: SparkSession, path: str, use: Callable) -> Any:
    """Call ``use`` with the file system that ``path`` names, whichever it is."""
    folder, settings = _folder(spark, path)
    return use(folder.getFileSystem(settings), folder)


def _folder(spark: SparkSession, path: str) -> tuple[Any, Any]:
    return (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path),
            spark.sparkContext._jsc.hadoopConfiguration())
