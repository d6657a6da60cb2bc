"""Ordered event sequences per group: running sums, streaks, halves.

``ordered_prefix`` gives running sums in (day, seq) order. When one group may be too big for a task, it adds
up per day first, runs over the days (bounded by the calendar), and only then runs inside a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.config import Policy
from tape_audit.operators.conventions import KEY
from tape_audit.operators.staging import stage


def ordered_prefix(
    df: DataFrame, keys: list[str], day: str, seq: str, values: dict[str, Column], *, giant: bool = False,
) -> DataFrame:
    """For each ``name: value`` add ``name`` (running sum up to and including the row) and ``name_total``
    (sum over the group). ``day`` must not be NULL."""
    rows = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    whole = Window.partitionBy(*keys)
    running = Window.unboundedPreceding, Window.currentRow
    if not giant:
        w = whole.orderBy(day, seq).rowsBetween(*running)
        rows = rows.withColumns({n: F.sum(f"_v_{n}").over(w) for n in values})
        rows = rows.withColumns({f"{n}_total": F.sum(f"_v_{n}").over(whole) for n in values})
        return rows.drop(*[f"_v_{n}" for n in values])
    days = rows.groupBy(*keys, day).agg(*[F.sum(f"_v_{n}").alias(f"_d_{n}") for n in values])
    earlier = whole.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(
        *keys, day,
        *[F.coalesce(F.sum(f"_d_{n}").over(earlier), F.lit(0).cast("bigint")).alias(f"_o_{n}") for n in values],
        *[F.sum(f"_d_{n}").over(whole).alias(f"{n}_total") for n in values],
    )
    within = Window.partitionBy(*keys, day).orderBy(seq).rowsBetween(*running)
    joined = rows.join(days, [*keys, day])
    joined = joined.withColumns({n: F.sum(f"_v_{n}").over(within) + F.col(f"_o_{n}") for n in values})
    return joined.drop(*[f"_v_{n}" for n in values], *[f"_o_{n}" for n in values])


def global_rank(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Global 1-based rank by ``order``, which must tell all rows apart. Rows are dealt into ranges of the whole order and
    sorted there; a row's rank is the size of the ranges before its own and its place inside. The ranges are stored once,
    so both readings see the same, and only their sizes, one row for each, pass through one task."""
    local = F.monotonically_increasing_id()  # the range's number stands above 33 bits of place
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", local), "ranked")
    part = F.shiftright("_place", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("_part", part).join(offsets, "_part").withColumn(
        out, F.col("_before") + inside + 1).drop("_part", "_place", "_before")


def late_runs(delays: DataFrame, grace: int, *, giant: bool = False) -> DataFrame:
    """Longest late streak and lateness trend per loan from (day, seq, delay, copies) rows.

    Gaps and islands: the running count of punctual rows numbers the islands of late ones. The trend is the
    mean delay of the second half minus that of the first; an odd middle row counts in the second half.
    """
    c = F.col
    late = c("delay") > grace
    rows = ordered_prefix(
        delays, KEY, "day", "payment_seq",
        {"rank": c("copies"), "punctual": F.when(late, F.lit(0)).otherwise(c("copies"))},
        giant=giant,
    )
    half = F.floor(c("rank_total") / 2)
    first = c("rank") <= half
    islands = rows.groupBy(*KEY, "punctual").agg(
        F.sum(F.when(late, c("copies")).otherwise(0)).alias("_run"),
        F.sum(F.when(first, c("delay")).otherwise(0)).alias("_s1"),
        F.sum(F.when(first, F.lit(0)).otherwise(c("delay"))).alias("_s2"),
        F.max("rank_total").alias("_n"),
    )
    return islands.groupBy(*KEY).agg(
        F.max("_run").alias("longest_late_streak"),
        F.sum("_s1").alias("_s1"), F.sum("_s2").alias("_s2"), F.max("_n").alias("_n"),
    ).select(
        *KEY, "longest_late_streak",
        F.try_divide("_s2", c("_n") - F.floor(c("_n") / 2)).alias("_m2"),
        F.try_divide("_s1", F.floor(c("_n") / 2)).alias("_m1"), c("_n").alias("n_delays"),
    )


def behaviour_profile(payments: DataFrame, policy: Policy, *, giant: bool = False) -> DataFrame:
    """Ordered part of the repayment profile per loan: streak, trend, median, usual days."""
    c = F.col
    delays = payments.filter("is_paid_delay").select(
        *KEY, c("due_date").alias("day"), "payment_seq", c("delay_days").alias("delay"), "actual_date",
        "copies")
    runs = late_runs(delays, policy.lateness.grace_days, giant=giant)
    typical = delays.groupBy(*KEY).agg(
        F.percentile("delay", 0.5, c("copies")).alias("median_delay_days"),
        F.mode(F.dayofmonth("day"), True).alias("usual_due_day"),
        F.mode(F.dayofmonth("actual_date"), True).alias("usual_paid_day"),
    )
    enough = c("n_delays") >= policy.lateness.trend_min_paid
    return runs.join(typical, KEY).select(
        *KEY, "longest_late_streak",
        F.when(enough, F.bround(c("_m2") - c("_m1"), 1)).alias("trend_days"),
        "median_delay_days", "usual_due_day", "usual_paid_day",
    )


def trailing_unpaid(payments: DataFrame, *, giant: bool = False) -> DataFrame:
    """Principal rows due by the as-of date that follow the last paid one, per loan."""
    c = F.col
    rows = payments.filter(
        c("is_regular") & (c("type") == "principal") & (c("days_past_due") >= 0)
    ).select(*KEY, c("due_date").alias("day"), "payment_seq", "is_paid", "copies")
    rows = ordered_prefix(
        rows, KEY, "day", "payment_seq", {"settled": F.when(c("is_paid"), c("copies")).otherwise(0)},
        giant=giant)
    open_tail = ~c("is_paid") & (c("settled") == c("settled_total"))
    return rows.groupBy(*KEY).agg(
        F.sum(F.when(open_tail, c("copies")).otherwise(0)).alias("unpaid_streak"),
        F.min(F.when(open_tail, c("day"))).alias("unpaid_since"),
    )
