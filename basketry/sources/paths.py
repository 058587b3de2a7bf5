"""File-system checks the table jobs need, on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the new name appears with all its files at once on file systems that rename."""
    fs, source = _resolve(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"can't move {path} to {to}")


def make(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.mkdirs(hadoop_path)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, hadoop_path = _resolve(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def delete_folder_of_rows(spark: SparkSession, uri: str) -> None:
    """Delete a folder named as ``_metadata.file_path`` names it, URL-encoded."""
    delete(spark, spark._jvm.java.net.URI(uri))


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ran to its end."""
    return exists(spark, f"{path}/_SUCCESS")
