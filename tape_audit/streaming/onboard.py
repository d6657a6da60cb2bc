"""Incremental arrival of tapes: a file stream whose micro-batches run the batch audit.

No state is kept in the stream. A run id made of source content, policy, rules and as-of date makes a repeated
batch or a re-delivered file a no-op.

``publish_files`` does the same for files that add to tables: a run is what is new in a micro-batch of several files, its
tables are written before its marker, and readers see only the tables of marked runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tape_audit.config import Policy
from tape_audit.operators.staging import stage
from tape_audit.plans.audit import audit, run_id, write_audit
from tape_audit.plans.ledger import with_row_index
from tape_audit.sources.reader import content_digest, grouped_digest
from tape_audit.sources.sinks import publish_table


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _known_run(spark: SparkSession, folder: str, run: str) -> bool:
    if not _exists(spark, f"{folder}/run"):
        return False
    return not spark.read.parquet(f"{folder}/run").filter(F.col("run_id") == run).isEmpty()


def audit_batch(rows: DataFrame, folder: str, policy: Policy) -> str | None:
    """Audit one arrived tape and publish its tables; returns the run id, or None when it is known. The run
    table is written last, so a run that died half-way is simply done again."""
    spark = rows.sparkSession
    if policy.as_of is None:
        raise ValueError("an arriving tape needs a pinned as-of date")
    if rows.isEmpty():
        return None
    digest = content_digest(rows)
    run = run_id(digest, policy, policy.as_of)
    if _known_run(spark, folder, run):
        return None
    raw = stage(with_row_index(rows), "arrived").withColumn("tape_id", F.lit(digest[:12]))
    result = audit(raw, policy, digest)
    meta = result.tables.pop("run")
    write_audit(result, folder)
    publish_table(meta, f"{folder}/run", result.tape_id)
    return run


def onboard(spark: SparkSession, source: str, columns: list[str], folder: str, checkpoint: str,
            policy: Policy) -> StreamingQuery:
    """Audit every JSON-lines tape that has arrived in ``source`` and stop; one file is one tape."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
    return (
        stream.writeStream.foreachBatch(lambda rows, _epoch: audit_batch(rows, folder, policy))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def incremental(source: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``process`` on whatever has arrived in any streaming source, then stop."""
    return (
        source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


SOURCE_FILE = "_source_file"
DELIVERIES = "deliveries"


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """(run, digest, file, rows) of every file whose run is published."""
    schema = "digest string, file string, rows long, run string"
    if not _exists(spark, f"{folder}/{DELIVERIES}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{DELIVERIES}")


def publish_files(rows: DataFrame, folder: str, make: Callable[[DataFrame], dict[str, DataFrame]]) -> str | None:
    """Publishes the tables that ``make`` gives for the new files of ``rows`` (with their path in ``SOURCE_FILE``), and
    returns the run, or None where every file is known. A file is known by its content, whatever its name.

    The run is named after its content and its marker is written last, as one file. A run that died half-way is not
    seen by ``published``; done again, it replaces what it had written."""
    spark = rows.sparkSession
    files = grouped_digest(rows, [SOURCE_FILE]).groupBy("digest").agg(F.min(SOURCE_FILE).alias("file"), F.max("rows").alias("rows"))
    fresh = stage(files.join(deliveries(spark, folder).select("digest"), "digest", "left_anti"), "fresh")
    if fresh.isEmpty():
        return None
    # one digest for each file of the micro-batch, whose number the stream limits
    run = "r" + fresh.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256).alias("run")).first()["run"][:31]
    new = rows.join(fresh.select(F.col("file").alias(SOURCE_FILE)), SOURCE_FILE, "left_semi").drop(SOURCE_FILE)
    for name, df in make(new).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/run={run}")
    fresh.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{DELIVERIES}/run={run}")
    return run


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of a table that finished runs have written, with their ``run``."""
    return spark.read.parquet(f"{folder}/{name}").join(deliveries(spark, folder).select("run").distinct(), "run", "left_semi")


def onboard_files(source: DataFrame, folder: str, checkpoint: str, make: Callable[[DataFrame], dict[str, DataFrame]]) -> StreamingQuery:
    """Publishes what has arrived in a file stream, then stops. ``maxFilesPerTrigger`` of the source bounds a run."""
    named = source.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return incremental(named, lambda rows, _epoch: publish_files(rows, folder, make), checkpoint)


def policy_for(as_of: str, base: dict | None = None) -> Policy:
    """Policy of one delivery: the as-of text must be a canonical ISO date."""
    parsed = date.fromisoformat(as_of)
    if parsed.isoformat() != as_of:
        raise ValueError("as-of must be a canonical ISO date")
    return Policy.from_dict({**json.loads(json.dumps(base or {})), "as_of": as_of})
