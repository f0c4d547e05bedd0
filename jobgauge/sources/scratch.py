"""Shared scratch space for intermediate tables."""

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a folder of the warehouse, which is shared too, where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root, removed when the session's JVM ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    file_system, hadoop_path = _hadoop(spark, path)
    file_system.deleteOnExit(hadoop_path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path that nothing reads any more."""
    file_system, hadoop_path = _hadoop(spark, path)
    file_system.delete(hadoop_path, True)


def moved(spark: SparkSession, path: str, to: str) -> bool:
    """Move a path to an unused one, whose parent is made; False if there is no such path."""
    file_system, source = _hadoop(spark, path)
    _, target = _hadoop(spark, to)
    if not file_system.exists(source):
        return False
    file_system.mkdirs(target.getParent())
    if not file_system.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")
    return True


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the scratch space and read back: computed once, and safe from lost executors.

    Shuffle files of earlier steps that no DataFrame refers to any more are then removed by Spark's cleaner, which waits
    for collections of the driver's garbage; one is asked for here, so that disks do not fill up in long plans.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    gc.collect()
    spark._jvm.java.lang.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove the folders of tables that `written` returned and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for path in {file.rpartition("/")[0] for file in table.inputFiles()[:1]}:
            remove(spark, path)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
