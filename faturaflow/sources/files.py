"""Small files on Spark's file systems: those of the driver only, such as a manifest."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    p, fs = hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written aside, then renamed: a reader sees the whole file or none. An existing file is replaced."""
    aside, fs = hadoop_path(spark, f"{path}.tmp")
    target, _ = hadoop_path(spark, path)
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(aside, target):
        fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"cannot rename {aside} to {target}")
