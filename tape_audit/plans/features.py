"""Loan-level features: everything the rules need, from pre-aggregated passes over the payments.

Plain counts, sums and extremes come from one aggregation per loan. What depends on distinct due dates is
aggregated per (loan, due date) first, which bounds a giant loan by its calendar. All of it combines on the
map side, in number-only buffers, and sums are exact integers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.config import Policy
from tape_audit.functions import irr
from tape_audit.functions.money import euros
from tape_audit.operators import conventions as C
from tape_audit.operators.staging import stage, stage_by
from tape_audit.plans.ledger import KEY, Ledger

# A (days, date) pair packed into one long, so that the worst case and its date come out of one plain max.
_DAY_SPAN = 10_000_000
_EPOCH_SHIFT = 5_000_000


def pack_worst(days: Column, due: Column) -> Column:
    """Orders by ``days`` and then by the earlier due date."""
    return days.cast("bigint") * _DAY_SPAN + (F.lit(_EPOCH_SHIFT) - F.unix_date(due)).cast("bigint")


def worst_days(packed: Column) -> Column:
    return F.floor(packed / F.lit(_DAY_SPAN)).cast("int")


def worst_due(packed: Column) -> Column:
    return F.date_from_unix_date((F.lit(_EPOCH_SHIFT) - F.pmod(packed, F.lit(_DAY_SPAN))).cast("int"))


# Date layouts, as codes so that their extremes stay in plain number aggregation buffers.
DATE_FORMATS = ("%d/%m/%Y", "%m/%d/%Y", "date", "datetime", "iso")


def format_code(fmt: Column) -> Column:
    out = F.when(fmt == DATE_FORMATS[0], 0)
    for code, name in enumerate(DATE_FORMATS[1:], start=1):
        out = out.when(fmt == name, code)
    return out


def format_name(code: Column) -> Column:
    return F.get(F.array(*[F.lit(f) for f in DATE_FORMATS]), code)


def _measures(policy: Policy, as_of: date) -> dict[str, tuple[str, Column, Column | None]]:
    """name -> (kind, flag, value). Kinds: n counts records, sum adds micros, max/min take extremes."""
    c = F.col
    t, state, paid = c("type"), c("state"), c("is_paid")
    amount, pending = c("amount"), c("pending_amount")
    late, tol = policy.lateness, policy.tolerance
    true = F.lit(True)
    both = amount.isNotNull() & pending.isNotNull()
    interest = (t == "interest") & c("is_interest_row")
    open_row = c("is_regular") & (c("exposure_eur") > 0)
    principal_cash = c("is_schedule_row") | c("is_settlement_cash")
    termination = t == C.TERMINATION
    cash = c("paid_eur") > 0
    paid_delay, unpaid = c("is_paid_delay"), c("is_unpaid_row")
    delay, dpd = c("delay_days"), c("days_past_due")
    default, medium = late.default_days, late.medium_days
    part_state = state.isin("pending", "pending late", "payment in grace period")
    c6 = both & ~c("is_settlement_marker")
    insane = ~F.coalesce(
        (F.size("issues") == 0) & c("record_loan_id").isNotNull() & c("due_date").isNotNull() & both
        & pending.between(F.lit(0.0), amount) & (~paid | c("actual_date").isNotNull()),
        F.lit(False),
    )
    lateness_packed = pack_worst(delay, c("due_date"))
    dpd_packed = pack_worst(dpd, c("due_date"))
    out: dict[str, tuple[str, Column, Column | None]] = {
        "n_all": ("n", true, None),
        "n_issue": ("n", F.size("issues") > 0, None),
        "n_insane": ("n", insane, None),
        "n_foreign": ("n", c("record_loan_id") != c("loan_id").cast("string"), None),
        "foreign_example": ("min", c("record_loan_id") != c("loan_id").cast("string"),
                            c("record_loan_id").try_cast("bigint")),
        "fmt_lo": ("min", true, F.least(format_code(c("due_fmt")), format_code(c("actual_fmt")))),
        "fmt_hi": ("max", true, F.greatest(format_code(c("due_fmt")), format_code(c("actual_fmt")))),
        "n_closure": ("n", c("is_closure_row"), None),
        "n_duplicate": ("n", c("is_duplicate"), None),
        # principal and interest sums
        "m_schedule": ("sum", c("is_schedule_row"), c("amount_micros")),
        "m_settlement": ("sum", c("is_settlement_cash"), c("amount_micros")),
        "m_principal_paid": ("sum", principal_cash, c("paid_micros")),
        "m_interest_paid": ("sum", interest, c("paid_micros")),
        "m_interest_pending": ("sum", interest & ~c("is_closure_row"), c("exposure_micros")),
        "m_overdue_paid": ("sum", (t == "overdue interest") & c("is_interest_row"), c("paid_micros")),
        "m_interest_open_all": ("sum", interest & ~c("is_closure_row"), c("amount_micros")),
        "m_interest_open_paid": ("sum", interest & ~c("is_closure_row"), c("paid_micros")),
        "m_any_interest_paid": ("sum", c("is_interest_row") & ~c("is_closure_row"), c("paid_micros")),
        "first_interest_due": ("min", interest & ~c("is_closure_row"), c("due_date")),
        # cash flows
        "n_cash": ("n", cash, None),
        "n_cash_undated": ("n", cash & c("actual_date").isNull(), None),
        "first_cash": ("min", cash, c("actual_date")),
        "last_cash": ("max", cash, c("actual_date")),
        "n_principal_undated": ("n", principal_cash & cash & c("actual_date").isNull(), None),
        # row arithmetic
        "n_negative": ("n", (amount < 0) | (pending < 0), None),
        "n_pending_above": ("n", pending > amount + 0.005, None),
        "n_paid_with_pending": ("n", c6 & paid & (pending > 0.005), None),
        "n_open_above": ("n", c6 & part_state & (pending > amount + 0.005), None),
        "n_open_part": ("n", c6 & part_state & (pending < amount - 0.005), None),
        "n_open_part_undated": (
            "n", c6 & part_state & (pending < amount - 0.005) & c("actual_date").isNull(), None),
        "n_zero_paid": ("n", paid & (F.abs(amount) < 0.005) & ~t.isin(*C.EARLY), None),
        # dates
        "first_due": ("min", true, c("due_date")),
        "last_due": ("max", true, c("due_date")),
        "first_actual": ("min", true, c("actual_date")),
        "last_actual": ("max", true, c("actual_date")),
        "last_paid": ("max", paid, c("actual_date")),
        "n_future_paid": ("n", paid & (c("actual_date") > F.lit(as_of)), None),
        "n_stale_grace": (
            "n", (state == "payment in grace period") & (dpd > tol.grace_state_days), None),
        "w_stale_grace": ("max", state == "payment in grace period", dpd_packed),
        "n_early": ("n", c("is_lateness_row") & paid & (delay < -3), None),
        "min_delay": ("min", c("is_lateness_row") & paid, delay),
        "n_mislabelled": (
            "n", c("is_lateness_row") & (state == "paid on time") & (delay > late.grace_days), None),
        "w_mislabelled": ("max", c("is_lateness_row") & (state == "paid on time"), lateness_packed),
        # lifecycle
        "n_open": ("n", open_row, None),
        "m_open": ("sum", open_row, c("exposure_micros")),
        "n_termination": ("n", termination, None),
        "n_claim": ("n", termination & (c("exposure_eur") > 0), None),
        "m_claim": ("sum", termination & (c("exposure_eur") > 0), c("exposure_micros")),
        "n_paid_undated": ("n", paid & c("actual_date").isNull(), None),
        "n_unpaid_dated": (
            "n", c("is_regular") & ~paid & (c("paid_eur") <= 0) & c("actual_date").isNotNull(), None),
        "closing_date": (
            "max", (t == C.FULL_EARLY) & paid & ~c("is_aborted_settlement"), c("actual_date")),
        # lateness
        "n_late_default": ("n", paid_delay & (delay >= default), None),
        "w_delay": ("max", paid_delay, lateness_packed),
        "n_late_band": ("n", paid_delay & (delay >= medium) & (delay < default), None),
        "w_late_band": ("max", paid_delay & (delay >= medium) & (delay < default), lateness_packed),
        "n_unpaid": ("n", unpaid, None),
        "n_overdue": ("n", unpaid & (dpd > 0), None),
        "w_overdue": ("max", unpaid & (dpd > 0), dpd_packed),
        "n_overdue_default": ("n", unpaid & (dpd >= default), None),
        "m_overdue_default": ("sum", unpaid & (dpd >= default), c("exposure_micros")),
        "n_overdue_band": ("n", unpaid & (dpd >= medium) & (dpd < default), None),
        "w_overdue_band": ("max", unpaid & (dpd >= medium) & (dpd < default), dpd_packed),
        # coverage table
        "n_regular": ("n", c("is_regular"), None),
        "n_regular_paid": ("n", c("is_regular") & paid, None),
        "n_early_rows": ("n", c("is_settlement_cash") & t.isin(*C.EARLY), None),
        "n_termination_cash": ("n", c("is_settlement_cash") & termination, None),
        "n_state_overdue": ("n", c("is_regular") & ~paid & (dpd > 0), None),
        "m_state_overdue": ("sum", c("is_regular") & ~paid & (dpd > 0), c("exposure_micros")),
        "max_state_dpd": ("max", c("is_regular") & ~paid & (dpd > 0), dpd),
        "next_due": ("min", c("is_regular") & ~paid & (c("due_date") >= F.lit(as_of)), c("due_date")),
        "n_paid_delays": ("n", paid_delay, None),
        "n_paid_late": ("n", paid_delay & (delay > late.grace_days), None),
        "m_paid_principal_type": ("sum", (t == "principal") & ~c("is_duplicate"), c("paid_micros")),
        "m_paid_fee_type": ("sum", (t == "contract fee repayment") & ~c("is_duplicate"), c("paid_micros")),
        "m_paid_via_closure": ("sum", c("is_schedule_row") & c("is_closure_row"), c("paid_micros")),
        "m_settlement_paid": ("sum", c("is_settlement_cash"), c("paid_micros")),
        # slots
        "n_principal_due": ("n", c("is_regular") & (t == "principal"), None),
    }
    for name, member in (("p", "principal"), ("i", "interest"), ("f", "contract fee repayment")):
        slot = c("is_regular") & (t == member) & c("due_date").isNotNull()
        out[f"slot_{name}"] = ("n", slot, None)
        out[f"slot_{name}_unpaid"] = ("n", slot & ~paid, None)
    return out


# Measures that are needed per due date: distinct due dates, slots, schedule steps and delay episodes.
_DAY_MEASURES = (
    "n_late_default", "n_overdue_default", "n_open", "n_regular", "n_paid_delays", "w_delay", "n_principal_due",
    "slot_p", "slot_p_unpaid", "slot_i", "slot_i_unpaid", "slot_f", "slot_f_unpaid",
)
_DAY_ONLY = ("n_principal_due", "slot_p", "slot_p_unpaid", "slot_i", "slot_i_unpaid", "slot_f", "slot_f_unpaid")
_EPISODES = {
    "due_late_default": "n_late_default", "due_overdue_default": "n_overdue_default", "due_open": "n_open",
    "periods": "n_regular", "periods_interest": "slot_i", "periods_principal": "slot_p",
}


def folded_sum(value: Column, flag: Column | None = None) -> Column:
    """Sum of value times copies; nothing to add is 0, and NULL is a sum that a long cannot hold."""
    wanted = value if flag is None else F.when(flag, value)
    product = F.try_multiply(wanted, F.col("copies"))
    whole = F.when(F.count(product) == 0, F.lit(0).cast("bigint")).otherwise(F.try_sum(product))
    return F.when(F.count(wanted) == F.count(product), whole)


def _first_pass(kind: str, flag: Column, value: Column | None) -> Column:
    if kind == "n":
        return F.sum(F.when(flag, F.col("copies")).otherwise(F.lit(0).cast("bigint")))
    if kind == "sum":
        return folded_sum(value, flag)
    return (F.max if kind == "max" else F.min)(F.when(flag, value))


def loan_measures(payments: DataFrame, policy: Policy, as_of: date) -> DataFrame:
    """One row per loan with payments: plain counts, sums and extremes in one pass (map-side combined)."""
    m = _measures(policy, as_of)
    return payments.groupBy(*KEY).agg(*[_first_pass(*m[n]).alias(n) for n in m if n not in _DAY_ONLY])


def calendar_measures(payments: DataFrame, policy: Policy, as_of: date) -> DataFrame:
    """One row per loan from its due-date calendar. A narrow aggregate per (loan, due date) comes first: it
    bounds a giant loan by its calendar and turns "distinct due dates" into plain counts."""
    m = _measures(policy, as_of)
    days = payments.filter("due_date IS NOT NULL").groupBy(*KEY, "due_date").agg(
        *[_first_pass(*m[n]).alias(n) for n in _DAY_MEASURES])
    c, loan = F.col, Window.partitionBy(*KEY).orderBy("due_date")
    late, tol = policy.lateness, policy.tolerance
    principal_day, paid_day = c("n_principal_due") > 0, c("n_paid_delays") > 0
    days = days.withColumns({
        "_previous": F.last(F.when(principal_day, c("due_date")), True).over(
            loan.rowsBetween(Window.unboundedPreceding, -1)),
        "_later": F.coalesce(F.sum(paid_day.cast("int")).over(
            loan.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)),
    })
    step = F.when(principal_day, F.datediff("due_date", "_previous"))
    delay = worst_days(c("w_delay"))
    recent = paid_day & (c("_later") < late.drift_recent_episodes)
    slots = ("slot_p", "slot_i", "slot_f")
    conflicts = sum((F.when(c(s) > 1, 1).otherwise(0) for s in slots), F.lit(0))
    conflict_open = F.lit(False)
    for s in slots:
        conflict_open = conflict_open | ((c(s) > 1) & (c(f"{s}_unpaid") > 0))
    count = F.count_if
    return days.groupBy(*KEY).agg(
        *[count(c(src) > 0).alias(out) for out, src in _EPISODES.items()],
        count((c("slot_i") > 0) & (c("slot_p") == 0)).alias("periods_interest_only"),
        count(principal_day).alias("principal_dates"),
        count(step > tol.schedule_gap_days).alias("schedule_gaps"),
        count(step < tol.schedule_min_gap_days).alias("schedule_doubles"),
        count(paid_day).alias("episodes"),
        F.max(F.when(paid_day & ~recent, delay)).alias("baseline_worst"),
        count(recent & (delay > late.grace_days)).alias("recent_exceeding"),
        F.sum(conflicts).alias("slot_conflicts"), F.max(conflict_open).alias("slot_conflict_open"),
    )


def claim_days(payments: DataFrame) -> DataFrame:
    """Days past due of each open termination claim, once per day: few loans, and bounded by the calendar."""
    claims = payments.filter((F.col("type") == C.TERMINATION) & (F.col("exposure_eur") > 0)
                             & F.col("due_date").isNotNull())
    return claims.groupBy(*KEY).agg(F.sort_array(F.collect_set("days_past_due")).alias("claim_days"))


def daily_reductions(payments: DataFrame) -> DataFrame:
    """Principal reductions per (loan, day): receipts on the day paid, open remainders on the day due."""
    c = F.col
    principal = c("is_schedule_row") | c("is_settlement_cash")
    events = payments.filter(principal).select(
        *KEY,
        F.explode(F.array(
            F.struct(c("actual_date").alias("day"),
                     F.when(c("paid_eur") > 0, c("paid_micros")).alias("m")),
            F.struct(c("due_date").alias("day"),
                     F.when(c("is_schedule_row"), c("exposure_micros")).alias("m")),
        )).alias("e"),
        "copies",
    )
    return (
        events.filter("e.day IS NOT NULL AND e.m IS NOT NULL AND e.m <> 0")
        .groupBy(*KEY, F.col("e.day").alias("day"))
        .agg(folded_sum(F.col("e.m")).alias("reduction"))
    )


def reduced_before(reductions: DataFrame, probes: DataFrame, parts: int | None = None) -> DataFrame:
    """As-of lookup without a theta join: total reduction strictly before each (loan, day) of ``probes``.
    Both sides are at day grain, so the running sum per loan is bounded by the calendar. A total that a long cannot
    hold, or that follows a NULL reduction, is NULL. A union loses the dealing by loan: with ``parts``, that of the stored
    payments, its rows are dealt so again, once for all steps that follow."""
    both = reductions.select(*KEY, "day", "reduction", F.lit(False).alias("_probe")).unionByName(
        probes.select(*KEY, "day", F.lit(0).cast("bigint").alias("reduction"), F.lit(True).alias("_probe"))
    )
    both = both if parts is None else both.repartition(parts, "source_row_index")
    merged = both.groupBy(*KEY, "day").agg(
        F.try_sum("reduction").alias("reduction"), F.max("_probe").alias("_probe"),
        F.max(F.col("reduction").isNull()).alias("_lost"))
    before = Window.partitionBy(*KEY).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return (
        merged.withColumn("reduced", F.when(F.count("*").over(before) == 0, F.lit(0).cast("bigint"))
                          .when(~F.max(F.col("_lost") | F.col("reduction").isNull()).over(before), F.try_sum("reduction").over(before)))
        .filter("_probe").select(*KEY, "day", "reduced")
    )


def _balance_days(payments: DataFrame, instalment: Column) -> DataFrame:
    """Total reduction strictly before each (loan, day) on which an ``instalment`` is due: ``reduced_before`` of
    ``daily_reductions`` and these days, from one reading of payments and without an exchange of a union."""
    c = F.col
    events = payments.select(
        *KEY,
        F.explode(F.array(
            F.struct(c("actual_date").alias("day"), F.when((c("is_schedule_row") | c("is_settlement_cash")) & (c("paid_eur") > 0), c("paid_micros")).alias("m"),
                     F.lit(False).alias("probe")),
            F.struct(c("due_date").alias("day"), F.when(c("is_schedule_row"), c("exposure_micros")).alias("m"), instalment.alias("probe")),
        )).alias("e"),
        "copies",
    ).filter(c("e.day").isNotNull() & (F.coalesce(c("e.m") != 0, F.lit(False)) | c("e.probe")))
    days = events.groupBy(*KEY, c("e.day").alias("day")).agg(
        folded_sum(c("e.m")).alias("reduction"), F.max(c("e.probe")).alias("_probe"))
    before = Window.partitionBy(*KEY).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn(
        "reduced", F.when(F.count("*").over(before) == 0, F.lit(0).cast("bigint"))
        .when(~F.max(c("reduction").isNull()).over(before), F.try_sum("reduction").over(before))
    ).filter("_probe").select(*KEY, "day", "reduced")


def interest_days(ledger: Ledger, policy: Policy) -> DataFrame:
    """Instalment interest against balance x rate / 12: one row per loan and due date with the number of checked and
    missed instalments, and whether a material excess stands alone."""
    c, tol = F.col, policy.tolerance
    instalment = F.coalesce((c("type") == "interest") & c("is_interest_row") & ~c("is_closure_row")
                            & c("due_date").isNotNull() & c("amount").isNotNull(), F.lit(False))
    rows = ledger.payments.filter(instalment).select(*KEY, c("due_date").alias("day"), "amount", "copies", "payment_seq")
    balances = _balance_days(ledger.payments, instalment)
    terms = ledger.loans.select(*KEY, "loan_amount", "interest_rate", "disbursal_date")
    expected = (
        balances.filter("reduced IS NOT NULL").join(terms, KEY)
        .withColumn("balance", F.greatest(c("loan_amount") - euros(c("reduced")), F.lit(0.0)))
        .withColumn("expected", c("balance") * (c("interest_rate") / 100.0 / 12.0))
    )
    checked = rows.join(expected, [*KEY, "day"]).withColumn(
        "miss",
        F.abs(c("amount") - c("expected"))
        > F.greatest(F.lit(tol.instalment_interest_eur), tol.instalment_interest_rel * c("expected")),
    )
    # per due day first; days with one instalment can be judged against their neighbours
    daily = checked.groupBy(*KEY, "day").agg(
        F.sum("copies").alias("n"),
        F.sum(F.when(c("miss"), c("copies")).otherwise(0)).alias("misses"),
        F.max("amount").alias("amount"), F.first("balance").alias("balance"),
        F.first("interest_rate").alias("rate"), F.first("disbursal_date").alias("disbursal_date"),
        F.first("expected").alias("expected"),
    )
    loan = Window.partitionBy(*KEY)
    seq = loan.orderBy("day")
    missed = c("misses") > 0
    daily = daily.withColumns({
        "_pos": F.row_number().over(seq), "_days": F.count(F.lit(1)).over(loan),
        "_single": F.max("n").over(loan) == 1,
        "_prev": F.lag("day").over(seq),
        "_p1": F.lag(missed).over(seq), "_p2": F.lag(missed, 2).over(seq),
        "_n1": F.lead(missed).over(seq), "_n2": F.lead(missed, 2).over(seq),
        "_before": F.max("amount").over(seq.rowsBetween(Window.unboundedPreceding, -1)),
        "_after": F.max("amount").over(seq.rowsBetween(1, Window.unboundedFollowing)),
    })
    clean_peers = (
        F.when(c("_pos") == 1, ~c("_n1") & ~c("_n2"))
        .when(c("_pos") == c("_days"), ~c("_p1") & ~c("_p2"))
        .otherwise(~c("_p1") & ~c("_n1"))
    )
    span = F.datediff("day", F.when(c("_pos") == 1, c("disbursal_date")).otherwise(c("_prev")))
    regular = (span > 0) & (
        (c("_pos") == 1) | span.between(tol.schedule_min_gap_days, tol.schedule_gap_days))
    bound = c("balance") * c("rate") / 100.0 * F.greatest(span / F.lit(360.0), F.lit(1.0 / 12.0))
    upper = F.greatest(bound, c("_before"), c("_after"))
    isolated = (
        missed & c("_single") & (c("_days") >= 3) & clean_peers & regular
        & (c("rate") != 0) & c("disbursal_date").isNotNull()
        & (c("amount") - upper > F.greatest(F.lit(tol.interest_eur), tol.instalment_interest_rel * upper))
    )
    return daily.withColumn("_isolated", F.coalesce(isolated, F.lit(False)))


def interest_accrual(ledger: Ledger, policy: Policy) -> DataFrame:
    """One row per loan with the number of checked and missed instalments and the isolated material excesses."""
    c = F.col
    return interest_days(ledger, policy).groupBy(*KEY).agg(
        F.sum("n").alias("interest_checked"), F.sum("misses").alias("interest_missed"),
        F.count_if("_isolated").alias("interest_isolated"),
        F.min(F.when(c("misses") > 0, c("day"))).alias("interest_first_miss"),
        F.min(F.when(c("_isolated"), c("day"))).alias("interest_first_isolated"),
    )


def rate_candidates(ledger: Ledger, policy: Policy) -> DataFrame:
    """Loans whose cash flows pass every precondition of a rate comparison. Cheap and narrow, so that the
    solver runs only where its result is used."""
    m = _measures(policy, ledger.as_of)
    names = ["n_all", "n_cash", "n_cash_undated", "first_cash", "last_cash",
             "m_interest_open_all", "m_interest_open_paid"]
    cash = ledger.payments.groupBy(*KEY).agg(*[_first_pass(*m[n]).alias(n) for n in names])
    return ledger.loans.join(cash, KEY).filter(rate_guard(policy, ledger.as_of)).select(
        *KEY, "loan_amount", "disbursal_date", "loan_status", "outstanding_principal")


def rate_guard(policy: Policy, as_of: date) -> Column:
    c, cfg = F.col, policy.irr
    live_ok = (
        (F.coalesce(c("loan_type"), F.lit("")) != "deferred annuity")
        & (c("m_interest_open_all") > 0)
        & (c("m_interest_open_paid") / c("m_interest_open_all") >= cfg.min_realised_interest_share)
        & c("outstanding_principal").isNotNull()
    )
    return F.coalesce(
        c("diary_error").isNull() & ~c("diary_truncated")
        & c("loan_amount").isNotNull() & c("interest_rate").isNotNull() & c("disbursal_date").isNotNull()
        & (c("n_cash_undated") == 0) & (c("first_cash") >= c("disbursal_date"))
        & (c("last_cash") <= F.lit(as_of)) & (c("n_cash") >= cfg.min_inflows)
        & (~F.coalesce(c("loan_status") == "granted", F.lit(False)) | live_ok),
        F.lit(False),
    )


def realised_rates(ledger: Ledger, candidates: DataFrame, policy: Policy) -> DataFrame:
    """IRR of the dated cash of each candidate loan, as paid and as if every late instalment had been paid
    when due. ``candidates`` are the loans that pass every guard, with their opening and closing flows."""
    c = F.col
    live = c("loan_status") == "granted"
    # three readers of few rows: without storing them, each would add up all payments again
    candidates = stage(candidates, "candidates") if ledger.giant_loans or ledger.parts is None else stage_by(
        candidates, "candidates", "source_row_index", ledger.parts)
    flow = lambda day, value: F.struct(day.alias("day"), value.alias("paid"), value.alias("scheduled"))
    ends = candidates.select(*KEY, F.explode(F.array_compact(F.array(
        flow(c("disbursal_date"), -c("loan_amount")),
        F.when(live, flow(F.lit(ledger.as_of), c("outstanding_principal"))),
    ))).alias("e")).select(*KEY, "e.*")
    cash = ledger.payments.filter("paid_eur > 0 AND actual_date IS NOT NULL").join(
        candidates.select(*KEY), KEY, "left_semi")
    on_time = F.when(c("is_regular") & (c("actual_date") > c("due_date")), c("due_date")).otherwise(
        c("actual_date"))
    value = c("paid_eur") * c("copies")
    zero = F.lit(0.0)
    moved = cash.select(*KEY, F.explode(F.array(
        F.struct(c("actual_date").alias("day"), value.alias("paid"), zero.alias("scheduled")),
        F.struct(on_time.alias("day"), zero.alias("paid"), value.alias("scheduled")),
    )).alias("e")).select(*KEY, "e.*")
    flows = ends.unionByName(moved)
    rates = irr.xirr(flows, KEY, "day", {"paid": "paid", "scheduled": "scheduled"},
                     policy.irr.low_rate_floor, policy.irr.high_rate_ceiling)
    return rates.select(*KEY, c("paid").alias("xirr"), c("scheduled").alias("xirr_on_schedule"))
