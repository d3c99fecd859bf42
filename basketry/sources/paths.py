"""Directory questions that Spark's readers do not answer, put to Hadoop's file system.

Only names and sizes pass through the driver, never data.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str, directories_only: bool = False) -> list[str]:
    """Names of what lies directly under ``path``."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(f"directory not found: {path}")
    return [
        s.getPath().getName()
        for s in fs.listStatus(at)
        if s.isDirectory() or not directories_only
    ]


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Whether a visible, non-empty file lies directly under ``path``."""
    fs, at = _file_system(spark, path)
    return any(
        s.isFile() and s.getLen() > 0 and s.getPath().getName()[0] not in "._"
        for s in fs.listStatus(at)
    )


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name below ``path``, bytes, time of the last change) of all visible files below it."""
    fs, at = _file_system(spark, path)
    base = fs.makeQualified(at).toString().rstrip("/") + "/"
    found, files = [], fs.listFiles(at, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString().removeprefix(base)
        if not any(part[0] in "._" for part in name.split("/")):
            found.append((name, status.getLen(), status.getModificationTime()))
    return found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def total_size(spark: SparkSession, path: str) -> int:
    """Bytes of all visible files below ``path``."""
    return sum(size for _, size, _ in data_files(spark, path))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place that ``spark.checkpoint.dir`` names.

    It goes when the application ends. Only a local session, such as a test, may fall back to a
    temporary folder: on a cluster the executors would each see a different one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        fs, at = _file_system(spark, folder)
        fs.mkdirs(at)
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _MADE.append((spark, folder))
    return folder


def remove_work_folders() -> None:
    """Delete the folders that ``work_folder`` has made in this process, and no others."""
    while _MADE:
        spark, folder = _MADE.pop()
        fs, at = _file_system(spark, folder)
        fs.delete(at, True)


@atexit.register
def _at_exit() -> None:
    # Spark may be gone already; then the folders stay.
    with contextlib.suppress(Exception):
        remove_work_folders()
