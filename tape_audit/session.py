"""Session settings the plans rely on, and a local session for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def tuned(spark: SparkSession) -> SparkSession:
    """The HotSpot JIT never compiles methods above 8,000 bytes of bytecode. Wide audits generate such
    methods, so stages that would exceed the limit are run with split functions instead."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, "8000")
    # rows dealt by the position of their loan need no second exchange to be joined by tape and position
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def spread(spark: SparkSession) -> int:
    """Partition count for CPU-heavy text work. Given explicitly, so that adaptive execution does not fold
    small text partitions whose parsing is anything but small."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cpus: int | str = "*", memory: str = "16g", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tape_audit")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)
