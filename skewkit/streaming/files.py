"""Folders of the shared file system, as the stream sinks use them (any file system that Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def folder_numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    """The numbers ``n`` of the folders ``<prefix>n`` in a folder."""
    found = [n[len(prefix):] for n in names(spark, path) if n.startswith(prefix)]
    return [int(n) for n in found if n.lstrip("-").isdigit()]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written the folder to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that nobody has written before: under a name of its own first, then renamed, which the file system
    does at once or not at all. False if ``path`` is there already, whoever wrote it."""
    import uuid
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, at = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{at.getParent().toString()}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(at), options)
    except Exception as refused:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(refused):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
