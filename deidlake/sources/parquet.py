"""Parquet "database": a directory with one ``<table>.parquet`` per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def list_tables(spark: SparkSession, directory: str, suffix: str = ".parquet") -> list[str]:
    """Table names under ``directory`` (file-system listing on the driver,
    works for any Hadoop file system)."""
    fs, hpath = _fs_and_path(spark, directory)
    names = []
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if name.endswith(suffix):
            names.append(name[: -len(suffix)])
    return sorted(names)
