"""Settlement conventions and row subsets of a payment history.

Scale notes. Tags that depend on other rows of the same day use windows over (loan, day), so even one giant
loan spreads over its days. The one fact that needs the whole loan (its last regular receipt) is a window
over the loan when histories come from single cells (a cell bounds the loan), and a pre-aggregated lookup,
replicated over row chunks, when they come from a flat detail table where one key may be arbitrarily hot.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.functions.money import micros

KEY = ["tape_id", "source_row_index"]
CHUNK_ROWS = 1 << 20

# Payment type families.
SCHEDULE = ("principal", "contract fee repayment")
INTEREST = ("interest", "overdue interest")
EARLY = ("full early repayment", "partial early repayment")
FULL_EARLY = "full early repayment"
TERMINATION = "repayment after agreement termination"
SLOT_TYPES = ("principal", "interest", "contract fee repayment")

TAGS = ["is_closure_row", "is_settlement_marker", "is_aborted_settlement", "is_duplicate"]
RECORD_IDENTITY = ["due_date", "type", "state", "amount", "pending_amount"]


def _any(flag: Column, window: Window) -> Column:
    return F.coalesce(F.max(flag).over(window), F.lit(False))


def chunk(seq: Column) -> Column:
    """Bounded slice of a loan's rows. Ordinary loans have exactly one."""
    return F.floor(seq / F.lit(CHUNK_ROWS)).cast("bigint")


def tag_conventions(payments: DataFrame, *, giant_loans: bool = False) -> DataFrame:
    """Tag closure rows, settlement markers, aborted settlements and identical copies.

    Only the later copies of an identical schedule or ordinary-interest record are tagged. Payments that are
    hash-partitioned by loan (as a ledger built from text cells is) need no further exchange.
    """
    rows = payments.withColumn("_day", F.coalesce("actual_date", "due_date"))
    same_day = Window.partitionBy(*KEY, "_day", "actual_date")
    early = F.col("type").isin(*EARLY)
    schedule = F.col("type").isin(*SCHEDULE)
    rows = rows.withColumn(
        "_early_paid", _any(early & F.col("is_paid") & F.col("actual_date").isNotNull(), same_day)
    )
    rows = rows.withColumn(
        "is_closure_row",
        F.col("type").isin(*SCHEDULE, *INTEREST) & F.col("_early_paid")
        & F.coalesce(F.col("actual_date") < F.col("due_date"), F.lit(False)),
    )
    copies = Window.partitionBy(*KEY, "_day", "actual_date", *RECORD_IDENTITY).orderBy("payment_seq")
    rows = rows.withColumns({
        "_closed_schedule": _any(F.col("is_closure_row") & schedule, same_day),
        "_copy": F.row_number().over(copies),
    })
    rows = rows.withColumns({
        "is_settlement_marker": early & (
            F.col("_closed_schedule")
            | (~F.col("is_paid") & (F.coalesce("pending_amount", F.lit(0.0)) == 0.0))
        ),
        "is_duplicate": F.col("type").isin(*SCHEDULE, "interest") & (F.col("_copy") > 1),
    })
    regular_receipt = F.when(schedule & F.col("is_paid") & ~F.col("is_closure_row"), F.col("actual_date"))
    if giant_loans:
        rows = _lookup_last_receipt(rows, regular_receipt)
    else:
        rows = rows.withColumn("_last_regular", F.max(regular_receipt).over(Window.partitionBy(*KEY)))
    rows = rows.withColumn(
        "is_aborted_settlement",
        (F.col("type") == FULL_EARLY) & F.col("is_paid") & ~F.col("is_settlement_marker")
        & F.coalesce(F.col("_last_regular") > F.col("actual_date"), F.lit(False)),
    )
    return rows.drop("_day", "_early_paid", "_closed_schedule", "_copy", "_last_regular")


def spread_lookup(rows: DataFrame, facts: DataFrame, last_chunk: str = "_last_chunk") -> DataFrame:
    """Left-join one fact row per loan to its records. The fact is replicated once per row chunk, so a giant
    loan's records meet it under many join keys; an ordinary loan has one chunk and one copy."""
    spread = facts.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(last_chunk, F.lit(0).cast("bigint"))))
    ).drop(last_chunk)
    return (
        rows.withColumn("_chunk", chunk(F.col("payment_seq")))
        .join(spread, [*KEY, "_chunk"], "left").drop("_chunk")
    )


def _lookup_last_receipt(rows: DataFrame, receipt: Column) -> DataFrame:
    """Only loans with a paid full settlement are looked up."""
    settlement = (F.col("type") == FULL_EARLY) & F.col("is_paid") & ~F.col("is_settlement_marker")
    facts = (
        rows.groupBy(*KEY)
        .agg(F.max(receipt).alias("_last_regular"),
             F.max(F.when(settlement, chunk(F.col("payment_seq")))).alias("_last_chunk"))
        .filter("_last_chunk IS NOT NULL AND _last_regular IS NOT NULL")
    )
    return spread_lookup(rows, facts)


def attach_loan(rows: DataFrame, loans: DataFrame, columns: list[str], *, giant_loans: bool) -> DataFrame:
    """Loan attributes on every record."""
    facts = loans.select(*KEY, *columns)
    if not giant_loans:
        return rows.join(facts, KEY, "left")
    extent = rows.groupBy(*KEY).agg(F.max(chunk(F.col("payment_seq"))).alias("_last_chunk"))
    return spread_lookup(rows, facts.join(extent, KEY))


def paid_portion() -> Column:
    """Cash implied by a row: amount minus a sane pending amount, else the state decides."""
    return (
        F.when(F.col("amount").isNull() | F.col("_no_cash"), F.lit(0.0))
        .when(F.col("pending_amount").between(F.lit(0.0), F.col("amount")),
              F.col("amount") - F.col("pending_amount"))
        .when(F.col("is_paid"), F.col("amount"))
        .otherwise(F.lit(0.0))
    )


def pending_portion() -> Column:
    """Exposure left on a row, with the same guards."""
    return (
        F.when(F.col("amount").isNull() | F.col("_no_cash"), F.lit(0.0))
        .when(F.col("pending_amount").between(F.lit(0.0), F.col("amount")), F.col("pending_amount"))
        .when(F.col("is_paid"), F.lit(0.0))
        .otherwise(F.col("amount"))
    )


def add_subsets(tagged: DataFrame, as_of: date) -> DataFrame:
    """Boolean subset columns, cash and exposure (euros and exact micros) and day counts."""
    t = F.col("type")
    rows = tagged.withColumn(
        "_no_cash",
        F.col("is_settlement_marker") | F.col("is_aborted_settlement") | F.col("is_duplicate"),
    )
    rows = rows.withColumns({
        "paid_eur": paid_portion(),
        "exposure_eur": pending_portion(),
        "delay_days": F.datediff("actual_date", "due_date"),
        "days_past_due": F.datediff(F.lit(as_of), F.col("due_date")),
        "is_regular": ~F.col("is_closure_row") & ~F.col("is_duplicate") & t.isin(*SCHEDULE, *INTEREST),
        "is_schedule_row": t.isin(*SCHEDULE) & ~F.col("is_duplicate"),
        "is_interest_row": t.isin(*INTEREST) & ~F.col("is_duplicate"),
        "is_settlement_cash": t.isin(*EARLY, TERMINATION)
        & ~F.col("is_settlement_marker") & ~F.col("is_aborted_settlement"),
    })
    rows = rows.withColumn(
        "is_lateness_row",
        F.col("is_regular") & t.isin(*SLOT_TYPES) & F.col("due_date").isNotNull(),
    )
    return rows.withColumns({
        "is_paid_delay": F.col("is_lateness_row") & (F.col("paid_eur") > 0)
        & F.col("delay_days").isNotNull(),
        "is_unpaid_row": F.col("is_lateness_row") & (F.col("exposure_eur") > 0)
        & (F.col("state") != "unknown"),
        "paid_micros": micros(F.col("paid_eur")),
        "exposure_micros": micros(F.col("exposure_eur")),
        "amount_micros": micros(F.col("amount")),
    }).drop("_no_cash")
