"""Raw tape scans: CSV, Parquet, JSON lines. Text sources are read as text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tape_audit.config import Policy
from tape_audit.plans.ledger import TapeRefusedError, check_schema, with_row_index


class SourceError(ValueError):
    """The source is missing, empty or of an unknown format."""


# Suffix to format.
FORMATS = {".csv": "csv", ".parquet": "parquet", ".jsonl": "jsonl", ".ndjson": "jsonl"}


def format_of(path: str) -> str:
    for suffix, fmt in FORMATS.items():
        if path.lower().rstrip("/").endswith(suffix):
            return fmt
    raise SourceError(f"unsupported file type: {path}")


def clean_headers(names: list[str]) -> list[str]:
    """Trimmed names; a nameless column becomes ``Unnamed: i``."""
    return [n.strip() or f"Unnamed: {i}" for i, n in enumerate(names)]


def lines_are_rows(spark: SparkSession, path: str) -> bool:
    """Whether every line of a CSV file is a row of its own, so that it may be read in splits. Proven line by line: with
    doubled quotes taken out, each quote must belong to a field that is quoted from border to border within its line.
    The proof is a parallel scan; where it fails, only a reader of whole files gives the right rows."""
    bare = F.regexp_replace(F.replace("value", F.lit('""'), F.lit("")), r'(^|,)"[^"]*"(?=,|\z)', "$1")
    return spark.read.text(path).where(F.contains(bare, F.lit('"'))).isEmpty()


def _csv_header(spark: SparkSession, path: str) -> list[str]:
    """The header as written, so that duplicate names stay visible: one record of the file."""
    row = spark.read.csv(path, header=False, inferSchema=False, multiLine=True, quote='"', escape='"').first()
    if row is None:
        raise SourceError("the tape contains no rows")
    return clean_headers([v or "" for v in row])


def _json_columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.json(path, primitivesAsString=True).columns


def read_tape(spark: SparkSession, path: str, fmt: str | None = None, *,
              columns: list[str] | None = None) -> DataFrame:
    """Tape with trimmed headers and without ``Unnamed`` columns; text sources as all strings. Duplicate
    headers and an empty tape are errors. ``columns`` (JSON lines) skips the schema scan."""
    fmt = fmt or format_of(path)
    if fmt == "csv":
        names = _csv_header(spark, path)
        repeated = sorted({n for n in names if names.count(n) > 1 and not n.startswith("Unnamed")})
        if repeated:
            raise TapeRefusedError(f"tape rejected: duplicate headers {repeated}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.schema(schema).csv(
            path, header=True, multiLine=not lines_are_rows(spark, path), quote='"', escape='"', enforceSchema=True)
    elif fmt == "jsonl":
        names = columns or _json_columns(spark, path)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.schema(schema).json(path)
        df = df.toDF(*clean_headers(df.columns))
    elif fmt == "parquet":
        df = spark.read.parquet(path)
        df = df.toDF(*clean_headers(df.columns))
    else:
        raise SourceError(f"unsupported format {fmt!r}")
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("Unnamed")])
    if df.isEmpty():
        raise SourceError("the tape contains no rows")
    return df


def count_rows(spark: SparkSession, path: str, fmt: str | None = None) -> int:
    """Data rows without materialising columns (Parquet: footer counts)."""
    fmt = fmt or format_of(path)
    if fmt == "csv":
        return spark.read.csv(path, header=True, multiLine=not lines_are_rows(spark, path), quote='"', escape='"').count()
    return (spark.read.parquet(path) if fmt == "parquet" else spark.read.text(path)).count()


def grouped_digest(df: DataFrame, by: list[str]) -> DataFrame:
    """Columns ``by``, ``rows`` and ``digest`` of each group. The digest is a sum of row hashes: it partitions freely, and
    a re-read of the same data gives the same value whatever the order and file layout."""
    names = sorted(c for c in df.columns if c not in by)
    cols = [F.to_json(F.col(f"`{n}`")) if isinstance(df.schema[n].dataType, (T.ArrayType, T.StructType, T.MapType))
            else F.col(f"`{n}`").cast("string") for n in names]
    h1 = F.xxhash64(*[F.coalesce(c, F.lit("\x00")) for c in cols]).cast("decimal(38,0)")
    h2 = F.hash(*[F.coalesce(c, F.lit("\x00")) for c in cols]).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("a"), F.sum(h2).alias("b")).select(
        *by, F.col("n").alias("rows"), F.sha2(F.concat_ws("|", F.lit(",".join(names)), "n", "a", "b"), 256).alias("digest"))


def content_digest(df: DataFrame) -> str:
    """Order-free digest of all rows."""
    return grouped_digest(df, []).first()["digest"]


def file_digest(spark: SparkSession, path: str) -> str:
    """Digest of one file's bytes, for tapes that arrive as single files."""
    row = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d")).first()
    if row is None:
        raise SourceError(f"input file not found: {path}")
    return row.d


def row_range(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Contiguous slice by source position."""
    return df.filter((F.col("source_row_index") >= start) & (F.col("source_row_index") < stop))


def load_tape(spark: SparkSession, path: str, fmt: str | None = None, policy: Policy = Policy(), *,
              digest: str | None = None) -> DataFrame:
    """Read, check the schema, and add the keys: ``tape_id`` (first 12 hex digits of the content digest) and
    ``source_row_index``."""
    df = read_tape(spark, path, fmt)
    schema = check_schema(df.columns, policy.dictionary)
    if not schema.ok:
        raise TapeRefusedError(f"tape rejected: required columns absent {list(schema.required_missing)}")
    digest = digest or content_digest(df)
    return with_row_index(df).withColumn("tape_id", F.lit(digest[:12]))
