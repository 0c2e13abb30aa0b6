"""Small helpers around the session: table access and cutting lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the path may be a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where the setting is absent, a folder of this machine serves a local
    session (tests); on a cluster, whose executors could not read it, that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    wanted = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not wanted and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(wanted or tempfile.mkdtemp(prefix="kinlink-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from those files; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like cut(), as a table in that folder: compressed and read by column, for wide rows of which later stages need a part."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove(*tables: DataFrame) -> None:
    """Delete the files of tables made by stored() that nothing refers to any more."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that shuffle files of tables that are no longer referred to are removed now and not at some time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
