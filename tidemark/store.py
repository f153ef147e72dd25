"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a temporary folder in local mode, an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="tidemark-"))
        where = _own_dir[0]
    return where.rstrip("/")


def forget(spark: SparkSession, path: str) -> None:
    """Delete a written table."""
    try:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:  # the session may have ended
        pass


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: the lineage ends there, and a lost
    executor costs a re-read only. The table goes when the process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(forget, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query that is built and run within go when it has run. Otherwise they stay until the driver
    happens to collect its garbage, and a job of several queries holds the files of all of them at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def layout(df: DataFrame, name: str, key: str, dealt: bool = False) -> DataFrame:
    """Write df dealt out by a key into as many buckets as the session has shuffle partitions, and read it back: joins,
    groups and windows by that key, of all tables laid out so, need no further shuffle. dealt: df is dealt out already
    (by deal(), or read from such tables and kept in its tasks). The table goes when the process ends."""
    spark = df.sparkSession
    table = f"spark_catalog.default.tidemark_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/tidemark/{table.rpartition('.')[2]}"
    d = df if dealt else deal(df, key)
    d.write.bucketBy(buckets(spark), key).option("path", path).format("parquet").saveAsTable(table)
    atexit.register(_undo, spark, table, path)
    out = spark.table(table)
    out._tidemark_path = path
    return out


def registered(spark: SparkSession, path: str, schema: str, key: str, n: int) -> DataFrame:
    """A table that layout() has written, in this session or another."""
    table = f"spark_catalog.default.tidemark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({key}) INTO {n} BUCKETS LOCATION '{path.replace("'", "''")}'")
    out = spark.table(table)
    out._tidemark_path = path
    return out


#: Tables that stay when the process ends.
_kept: set[str] = set()


def keep(df: DataFrame) -> str:
    """The path of a table that layout() has written; it is not deleted at the process's end."""
    _kept.add(df._tidemark_path)
    return df._tidemark_path


def drop_kept(spark: SparkSession, path: str) -> None:
    _kept.discard(path)
    forget(spark, path)


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(buckets(df.sparkSession), key)


def _undo(spark: SparkSession, table: str, path: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:  # the session may have ended
        pass
    if path not in _kept:
        forget(spark, path)


def drop_table(df: DataFrame) -> None:
    """Delete a table that materialise() wrote and that no later step reads."""
    if path := getattr(df, "_tidemark_path", None):
        forget(df.sparkSession, path)
