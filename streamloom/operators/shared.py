"""Names that cannot clash with a caller's columns, the shared folder, and small guards."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of the columns operators add for themselves.
OWN = "__sl_"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder's path under the cluster's shared folder (spark.checkpoint.dir).

    Where that is unset a session on one machine uses a folder beside its warehouse;
    on a cluster it is an error, as executors may not see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-shared"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(path, its file system), as Hadoop has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """The path, to be deleted when the application ends."""
    p, fs = file_system(spark, path)
    fs.deleteOnExit(p)
    return path


def removed(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def landed(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The rows of df from a Parquet table in the shared folder, and its path, which goes at the end of the application."""
    spark = df.sparkSession
    path = removed_at_exit(spark, shared_dir(spark, purpose))
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def write_and_read(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder (survives executor loss)."""
    return landed(df, purpose)[0]


def require_columns(df: DataFrame, columns: list[str], who: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{who}: missing columns {missing}; has {df.columns}")


def mixed(parts: list[DataFrame], key: str) -> DataFrame:
    """The union of parts by name, for windows and aggregates by `key`.

    Spark 4.1 lets a union hand on the partitioning its children share; where adaptive
    execution then joins their partitions differently, an aggregate above it skips its exchange
    and gives a group twice. Here the key of the last part is computed, so the union claims
    none, whatever the session's settings are.
    """
    *first, last = parts
    return reduce(DataFrame.unionByName, [*first, last.withColumn(key, F.element_at(F.array(F.col(key)), 1))])
