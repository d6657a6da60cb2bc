"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Every source's documents are laid out in a shuffled order as one stream of words, cut into blocks of equal length. The
slots of the schedule are points of the golden-ratio sequence, mapped through the cumulative shares of the sources;
a source's n-th slot takes its n-th block, and a second pass over the stream follows the first. Any run of slots
then holds the sources close to their shares. The last block of a source is cut where its target is reached, so the
words taken are exact.

No step gathers a source: positions and ranks come from totals of fine buckets and a window inside each bucket, and
blocks meet slots in an equality join on (source, block).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.operators.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by code point of the source's name, repeating; documents without a source come last
SHARE = 1.5
MOST = 2
BLOCK = 1024  # words
GOLDEN = 0.6180339887498949
CELLS = 4096
CHUNK = 1024  # slots
HEX = 3  # digits of the shuffle key that name a bucket


@dataclass
class Mix:
    documents: DataFrame  # doc_id, source, size, sid, start, source_size, target
    pieces: DataFrame  # slot, sid, pass, block, start (of the document), first (word of the document), words


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sized: DataFrame) -> DataFrame:
    """A row for each source. Filling to a common level per weight, each up to its cap, is what repeated resharing of
    the excess comes to: in the order of cap by weight, the level is the greatest of what is left by weight left."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", F.row_number().over(named) - 1)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("sid") % len(WEIGHTS) + 1).cast("long"))
    before = lambda c: F.coalesce(F.sum(c).over(filled), F.lit(0))
    left = F.sum("source_size").over(every) * SHARE - MOST * before("source_size")
    sources = sources.withColumn("level", left / (F.sum("weight").over(every) - before("weight")))
    target = F.least((MOST * F.col("source_size")).cast("double"), F.max("level").over(every) * F.col("weight"))
    return sources.select("sid", "source", "source_size", target.alias("target"), F.floor(target + 0.5).alias("quota"))


def _positions(marked: DataFrame) -> DataFrame:
    """``start``: words of the source's stream before each document."""
    bucket = Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = marked.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    offsets = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = marked.withColumn("inside", F.coalesce(F.sum("size").over(bucket), F.lit(0)))
    return inside.join(offsets, ["sid", "bucket"]).withColumn("start", F.col("offset") + F.col("inside")).drop("offset", "inside", "key", "bucket")


def _schedule(sources: DataFrame, block: int) -> DataFrame:
    """(slot, sid, n): the n-th slot of each source, for as many as its target needs."""
    rest = F.greatest(F.col("quota") - F.col("source_size"), F.lit(0))
    per_pass = F.ceil(F.col("source_size") / block)
    needed = sources.withColumn("slots", F.when(rest > 0, per_pass + F.ceil(rest / block)).otherwise(F.ceil(F.col("quota") / block)))
    order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    shares = needed.select("sid", "slots", F.coalesce(F.sum("slots").over(order), F.lit(0)).alias("from_slot"), F.sum("slots").over(Window.partitionBy()).alias("all_slots"))
    shares = shares.where("slots > 0").select("sid", "slots", (F.col("from_slot") / F.col("all_slots")).alias("low"), ((F.col("from_slot") + F.col("slots")) / F.col("all_slots")).alias("high"))
    shares = stage(shares, "shares")
    total = shares.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    cells = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))))
    point = (F.col("id") + 0.5) * GOLDEN
    points = sources.sparkSession.range(total).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("point"))
    mapped = points.withColumn("cell", F.floor(F.col("point") * CELLS)).join(cells, "cell").where("point >= low and point < high")
    mapped = stage(mapped.select("slot", "sid", F.floor(F.col("slot") / CHUNK).alias("chunk")), "slots")
    counts = mapped.groupBy("sid", "chunk").count()
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("sid", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = mapped.withColumn("inside", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    ranked = inside.join(offsets, ["sid", "chunk"]).select("slot", "sid", (F.col("offset") + F.col("inside")).alias("n"))
    given = shares.join(counts.groupBy("sid").agg(F.sum("count").alias("given")), "sid", "left")
    late = given.where("slots > coalesce(given, 0)").select("sid", F.explode(F.sequence(F.coalesce("given", F.lit(0)), F.col("slots") - 1)).alias("n"))
    used = ranked.join(shares.select("sid", "slots"), "sid").where("n < slots").select("slot", "sid", "n")
    return used.unionByName(late.select((F.lit(total) + F.col("n")).alias("slot"), "sid", "n"))


def mix(docs: DataFrame, block: int = BLOCK) -> Mix:
    """The mix of ``docs`` (doc_id, text, source; other columns are ignored).

    Null and empty texts have no words and are never taken. Repeated rows and rows that share a doc_id are documents
    of their own. Documents without a source, or without an id, are kept; an empty table gives an empty mix.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = stage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), key.alias("key")), "sizes")
    sources = stage(_targets(sized), "targets")
    number = sources.select("sid", F.col("source").alias("its_source"), "source_size", "target")
    marked = sized.join(number, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    placed = stage(_positions(marked.withColumn("bucket", F.conv(F.substring("key", 1, HEX), 16, 10).cast("int"))), "positions")
    ends = F.col("start") + F.col("size")
    spans = placed.where("size > 0").select("sid", "start", ends.alias("end"), F.explode(
        F.sequence(F.floor(F.col("start") / block), F.floor((ends - 1) / block))).alias("block"))
    per_pass = F.ceil(F.col("source_size") / block)
    slots = _schedule(sources, block).join(sources.select("sid", "source_size", "quota"), "sid").select(
        "slot", "sid", F.floor(F.col("n") / per_pass).alias("pass"), (F.col("n") % per_pass).alias("block"), "source_size", "quota",
    ).withColumn("upto", F.least((F.col("block") + 1) * block, F.col("quota") - F.col("pass") * F.col("source_size")))
    low, high = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("end"), F.col("upto"))
    pieces = spans.join(slots, ["sid", "block"]).where(high > low).select(
        "slot", "sid", "pass", "block", "start", (low - F.col("start")).alias("first"), (high - low).alias("words"))
    return Mix(placed, pieces)


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``: the words that the mix takes of it."""
    made = mix(docs, block)
    words = made.pieces.groupBy("sid", "start").agg(F.sum("words").alias("taken"))
    own = made.documents.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
    return own.join(words.withColumnRenamed("start", "at"), ["sid", "at"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


TAKEN_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (SELECT *, [3, 1, 2][(sid % 3 + 1)::INT]::BIGINT AS weight FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - 2 * coalesce(sum(source_size) OVER f, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0))::DOUBLE AS level
  FROM w WINDOW f AS (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM l
), p AS (
  SELECT d.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, quota) - start)
        + greatest(0, least(source_size + start + size, quota) - source_size - start))::BIGINT AS taken
FROM p
"""
