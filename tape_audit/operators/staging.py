"""Cutting lineage through shared storage.

A prepared table that feeds several jobs is written once as Parquet into the shared folder the cluster names in
``spark.checkpoint.dir``. Each reader then prunes its own columns, and a lost executor costs a re-read, not a
recomputation. ``drop_staged`` removes what a session staged once its results are published.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def shared_dir(spark: SparkSession, folder: str | None = None) -> str:
    """``folder`` if given, else the session's ``spark.checkpoint.dir``. Where neither names one, the folder of
    ``setCheckpointDir`` is taken, and a temporary one is set for sessions that have none at all (tests)."""
    configured = folder or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def staged_root(spark: SparkSession, folder: str | None = None) -> str:
    return f"{shared_dir(spark, folder)}/staged/{spark.sparkContext.applicationId}"


_PATHS: dict[str, list[str]] = {}  # of each application's staged tables
_TABLES: dict[str, str] = {}  # names of those that are bucketed, by path


def _writer(df: DataFrame) -> DataFrameWriter:
    """Numbers are stored as they are: a table that is read a few times at once costs more by its dictionaries than by
    its size. Texts keep theirs."""
    plain = [n for n, kind in df.dtypes if kind in ("bigint", "double")]
    return df.write.options(**{f"parquet.enable.dictionary#{n}": "false" for n in plain})


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    path = f"{staged_root(df.sparkSession, folder)}/{name}-{uuid.uuid4().hex}"
    _writer(df).parquet(path)
    _PATHS.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, name: str, key: str, parts: int, folder: str | None = None) -> DataFrame:
    """Stores ``df`` in ``parts`` buckets by ``key``, so that no reader has to exchange it for a group, window or join by
    that key. ``df`` should be partitioned by hash of the key into as many parts; then every task writes its own bucket."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = f"{staged_root(spark, folder)}/{table}"
    _writer(df).format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(table)
    _PATHS.setdefault(spark.sparkContext.applicationId, []).append(path)
    _TABLES[path] = table
    return spark.table(table)


def staged_tables(spark: SparkSession) -> list[str]:
    """Paths of the tables that this application has staged and not dropped."""
    return list(_PATHS.get(spark.sparkContext.applicationId, ()))


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Removes staged tables that nothing will read any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _forget(spark, path)
        _PATHS[spark.sparkContext.applicationId].remove(path)


def _forget(spark: SparkSession, path: str) -> None:
    if path in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")


def drop_staged(spark: SparkSession, folder: str | None = None) -> None:
    """Removes every table this application has staged; call it after the results that read them are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged_root(spark, folder))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for staged in _PATHS.pop(spark.sparkContext.applicationId, ()):
        _forget(spark, staged)
