"""The few file-system calls Spark's readers and writers do not offer."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    target, fs = _resolve(spark, pattern)
    return sorted(str(status.getPath()) for status in fs.globStatus(target) or [])


def read_text(spark: SparkSession, path: str) -> str:
    """Read one small file; underscore-prefixed names are hidden from Spark's own readers."""
    target, fs = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file, in place of one that is there."""
    target, fs = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers one alone gets True."""
    target, fs = _resolve(spark, path)
    fs.mkdirs(target.getParent())
    files = spark._jvm.java.nio.file
    try:
        if fs.getScheme() == "file":
            # Hadoop's local file system looks first and creates then; Java's own call does both at once
            local = spark._jvm.java.io.File(target.toUri().getPath()).toPath()
            files.Files.createFile(local, spark.sparkContext._gateway.new_array(files.attribute.FileAttribute, 0))
        else:
            fs.create(target, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
