"""Files and folders of any file system that the session can reach (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """``(path, time of change)`` of what matches a glob pattern, by path."""
    fs, p = _at(spark, pattern)
    return sorted((s.getPath().toString(), int(s.getModificationTime())) for s in fs.globStatus(p) or [])


def make(spark: SparkSession, folder: str) -> None:
    fs, p = _at(spark, folder)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target must not be there."""
    fs, p = _at(spark, source)
    t = _at(spark, target)[1]
    if t.getParent() is not None:
        fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
