"""Where tables lie."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def path_resolve(spark: SparkSession, candidates: list[str]) -> str:
    """The first existing path; FileNotFoundError if there is none."""
    for c in candidates:
        if exists(spark, c):
            return c
    raise FileNotFoundError("none of these exists: " + ", ".join(candidates))
