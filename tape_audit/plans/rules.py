"""The 50 per-loan checks as Column expressions over one feature row per loan.

A check is a list of reasons not to evaluate it, a failure condition, and what to say. All checks of a loan
are evaluated in one projection and unpivoted by one explode; no data moves.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.config import SEVERITIES, Policy
from tape_audit.functions.money import eur_text, euros, money
from tape_audit.operators.sequences import behaviour_profile, trailing_unpaid
from tape_audit.plans import features as X
from tape_audit.plans.catalog import BY_ID, DEFAULT_RULES, EVIDENCE_CATEGORIES, ORDINAL, RULES, WATCH_RULES
from tape_audit.plans.ledger import KEY, Ledger

# Summary fields whose parse issues count as numeric or date faults.
NUMERIC_FIELDS = (
    "Loan amount", "Interest rate", "Loan term", "Monthly payment", "Days late", "Outstanding principal",
    "Repaid principal", "Outstanding interest", "Repaid interest", "Arrears", "Delay interest",
)
DATE_FIELDS = ("Disbursal date", "Expected repayment date", "Repayment date")

Skip = tuple[Column, str, bool]


@dataclass
class Check:
    fail: Column
    message: Column
    skips: list[Skip] = field(default_factory=list)
    severity: Column | None = None
    standalone: Column | None = None
    evidence: dict[str, Column] = field(default_factory=dict)


#: What is told in public where the full message quotes the loan's own values.
FIXED_MESSAGES = {
    "A6": "at least one category is absent or not in the dictionary",
    "A7": "no payment history to check against",
    "A9": "some payment records could not be typed",
    "A10": "a payment record names a different loan number",
    "H3": "the instalment is high for the income on file",
    "H4": "company and person fields contradict each other",
    "H10": "work status and income do not fit together",
}

PARTS = ("main", "calendar", "claims", "accrual", "rates", "profile", "tail")
#: Parts, and columns of the other parts, that texts and the tables by loan read and no check, severity or cause.
TOLD_PARTS = ("profile",)
TOLD_COLUMNS = (
    "loan_id_raw", "diary_raw_chars", "dropped_tail_chars", "n_all", "n_insane", "foreign_example", "n_closure", "n_open_part_undated",
    "last_due", "last_actual", "w_stale_grace", "min_delay", "w_mislabelled", "n_claim", "n_unpaid", "m_overdue_default", "n_regular",
    "n_regular_paid", "n_early_rows", "n_termination_cash", "n_state_overdue", "m_state_overdue", "max_state_dpd", "next_due",
    "m_paid_principal_type", "m_paid_fee_type", "m_paid_via_closure", "m_settlement_paid", "due_late_default", "due_overdue_default",
    "due_open", "periods", "periods_interest", "periods_principal", "periods_interest_only", "interest_first_miss",
    "interest_first_isolated", "unpaid_since",
)
_COUNTS = (
    "due_late_default", "due_overdue_default", "due_open", "periods", "periods_interest",
    "periods_principal", "periods_interest_only", "principal_dates", "schedule_gaps", "schedule_doubles",
    "episodes", "recent_exceeding", "slot_conflicts", "interest_checked", "interest_missed",
    "interest_isolated", "unpaid_streak",
)


def assess(ledger: Ledger, policy: Policy = Policy(), parts: tuple[str, ...] = PARTS) -> DataFrame:
    """One row per loan: typed summary fields and the payment features of ``parts``. Loans without records
    survive. ``ledger`` must be prepared; with several parts its payments should be staged first. What is joined is one
    struct of each part, so that a join copies a handful of columns and not all features that were joined before."""
    c, p, giant = F.col, ledger.payments, ledger.giant_loans
    build = {
        "main": lambda: X.loan_measures(p, policy, ledger.as_of),
        "calendar": lambda: X.calendar_measures(p, policy, ledger.as_of),
        "claims": lambda: X.claim_days(p),
        "accrual": lambda: X.interest_accrual(ledger, policy),
        "rates": lambda: X.realised_rates(ledger, X.rate_candidates(ledger, policy), policy),
        "profile": lambda: behaviour_profile(p, policy, giant=giant),
        "tail": lambda: trailing_unpaid(p, giant=giant),
    }
    own = [n for n in ledger.loans.columns if n not in KEY]
    wide, columns = _packed(ledger.loans, "_loan"), [c("_loan")[n].alias(n) for n in own]
    for name in parts:
        part = build[name]()
        wide = wide.join(_packed(part, f"_{name}"), KEY, "left")
        columns += [c(f"_{name}")[n].alias(n) for n in part.columns if n not in KEY]
    wide = wide.select(*KEY, *columns)
    zero = [n for n in wide.columns if (n[:2] in ("n_", "m_") and n != "n_records") or n in _COUNTS]
    sums = [n for n, m in X._measures(policy, ledger.as_of).items() if m[0] == "sum"] if "main" in parts else []
    absent = {n: c("n_regular").isNull() if n in sums else c(n).isNull() for n in zero}  # a NULL sum of a loan with records is beyond range
    return wide.withColumns({n: F.when(absent[n], F.lit(0).cast("bigint")).otherwise(c(n)) for n in zero})


def _packed(df: DataFrame, name: str) -> DataFrame:
    return df.select(*KEY, F.struct(*[n for n in df.columns if n not in KEY]).alias(name))


def text(*parts: object) -> Column:
    return F.concat(*[
        F.lit(p) if isinstance(p, str)
        else F.coalesce(p.cast("string"), F.lit("?")) if isinstance(p, Column) else F.lit(str(p))
        for p in parts
    ])


def _diary_skips(complete: bool = False) -> list[Skip]:
    skips: list[Skip] = [
        (F.col("diary_error").isNotNull(), "diary_unreadable", False),
        (F.col("n_records") == 0, "diary_empty", False),
    ]
    if complete:
        skips.append((F.col("diary_truncated"), "diary_truncated", False))
    return skips


def _absent(ledger_missing: frozenset[str], column: str) -> Column:
    return F.lit(column in ledger_missing)


def _any_null(*names: str) -> Column:
    flag = F.lit(False)
    for n in names:
        flag = flag | F.col(n).isNull()
    return flag


def _readability(policy: Policy, missing: frozenset[str]) -> dict[str, Check]:
    c, d = F.col, policy.dictionary

    def faulty(fields: tuple[str, ...]) -> Column:
        hit = F.filter("parse_issues", lambda i: i["field"].isin(*fields))
        return F.array_sort(F.array_distinct(F.transform(hit, lambda i: i["field"])))

    numeric, dates = faulty(NUMERIC_FIELDS), faulty(DATE_FIELDS)

    def outside(column: str, name: str, values: tuple[str, ...], required: bool = False) -> Column:
        if name in missing:
            return F.lit(None).cast("string")
        bad = F.when(c(column).isNotNull(), ~c(column).isin(*values)).otherwise(F.lit(required))
        return F.when(bad, F.lit(name))

    strange = F.array_compact(F.array(
        outside("loan_status", "Loan status", d.loan_status_values, True),
        outside("loan_type", "Loan type", d.loan_type_values),
        outside("borrower_type", "Borrower type", d.borrower_type_values),
        outside("credit_score", "Credit score", d.credit_score_values),
    ))
    coded = F.coalesce(c("purpose").rlike(d.purpose_code_pattern), F.lit(False))
    diary = _diary_skips()
    return {
        "A2": Check(c("borrower_id").isNull(), text("no borrower identifier"),
                    [(_absent(missing, "Borrower ID"), "column_absent", False)],
                    evidence={"field": F.lit("Borrower ID")}),
        "A3": Check(F.size(numeric) > 0, text("unreadable numeric summary fields: ",
                                              F.array_join(numeric, ", ")),
                    evidence={"fields": F.array_join(numeric, ", ")}),
        "A4": Check(F.size(dates) > 0, text("unreadable summary dates: ", F.array_join(dates, ", ")),
                    evidence={"fields": F.array_join(dates, ", ")}),
        "A5": Check(c("fmt_lo") != c("fmt_hi"),
                    text("payment dates are written in several formats, such as ", X.format_name(c("fmt_lo")),
                         " and ", X.format_name(c("fmt_hi"))),
                    diary, evidence={"formats": text(X.format_name(c("fmt_lo")), ", ",
                                                     X.format_name(c("fmt_hi")))}),
        "A6": Check((F.size(strange) > 0) | coded,
                    F.when(F.size(strange) > 0, text("values outside the vocabulary: ",
                                                     F.array_join(strange, ", ")))
                    .otherwise(text("purpose is an untranslated code")),
                    severity=F.when(F.size(strange) == 0, F.lit("low")),
                    evidence={"fields": F.array_join(
                        F.concat(strange, F.when(coded, F.array(F.lit("Purpose"))).otherwise(
                            F.array().cast("array<string>"))), ", ")}),
        "A7": Check(c("diary_error").isNotNull() | (c("n_records") == 0),
                    text("payment history is ", F.when(c("diary_error").isNotNull(), "unreadable")
                         .otherwise("empty")),
                    evidence={"raw_length": c("diary_raw_chars")}),
        "A8": Check(c("diary_truncated"),
                    text("payment history was cut at ", c("diary_raw_chars"), " characters; ",
                         c("n_records"), " whole records kept"),
                    [(c("diary_error").isNotNull(), "diary_unreadable", False)],
                    evidence={"raw_length": c("diary_raw_chars"), "records_salvaged": c("n_records"),
                              "dropped_tail_chars": c("dropped_tail_chars")}),
        "A9": Check(c("n_issue") > 0, text(c("n_issue"), " of ", c("n_all"), " payment records are malformed"),
                    diary, evidence={"bad_records": c("n_issue")}),
        "A10": Check(c("n_foreign") > 0, text(c("n_foreign"), " payment records carry another loan's ID"),
                     diary, evidence={"expected": c("loan_id"), "found": c("foreign_example")}),
    }


def _identity(policy: Policy, missing: frozenset[str], as_of: date) -> dict[str, Check]:
    c, tol = F.col, policy.tolerance
    whole = _diary_skips(True)
    amount = c("loan_amount")
    scheduled, settled = euros(c("m_schedule")), euros(c("m_settlement"))
    total = euros(F.try_add("m_schedule", "m_settlement"))
    split = c("repaid_principal") + c("outstanding_principal")
    b1 = total - amount
    b2 = c("outstanding_principal") + c("repaid_principal") - amount
    b3 = euros(c("m_principal_paid")) - c("repaid_principal")

    def summary_gap(column: str, measure: str) -> tuple[Column, Column]:
        summary = F.coalesce(c(column), F.lit(0.0))
        return euros(c(measure)) - summary, summary

    def interest(rule_column: str, typed: str, measure: str, what: str) -> Check:
        gap, summary = summary_gap(typed, measure)
        return Check(
            F.abs(gap) > tol.interest_eur,
            text("payment records show ", eur_text(euros(c(measure))), " ", what, ", the summary ",
                 eur_text(summary)),
            [*whole, (_absent(missing, rule_column), "column_absent", True),
             (c(measure).isNull(), "sum_beyond_range", True)],
            evidence={"diary": money(euros(c(measure))), "summary": money(summary), "gap": money(gap)},
        )

    overdue = F.coalesce(X.worst_days(c("w_overdue")), F.lit(0))
    close = F.abs(overdue - c("days_late")) <= tol.days_late_days
    claims = F.exists("claim_days", lambda v: F.abs(v - c("days_late")) <= tol.days_late_days)
    months = lambda d: (
        (F.year(d) - F.year("disbursal_date")) * 12 + F.month(d) - F.month("disbursal_date"))
    slack = max(1, round(tol.expected_repayment_days / 30))
    fits = F.exists("expected_readings", lambda d: F.abs(months(d) - c("loan_term_months")) <= slack)
    return {
        "B1": Check(
            F.abs(b1) > tol.amount_eur,
            text("scheduled principal ", eur_text(scheduled), " plus settlements ", eur_text(settled),
                 " misses the loan amount ", eur_text(amount), " by ", eur_text(F.abs(b1))),
            [*whole, (amount.isNull(), "loan_amount_missing", True), (total.isNull(), "sum_beyond_range", True)],
            severity=F.when(F.abs(b1) > tol.principal_gap_material_share * amount, "high")
            .when(split.isNull(), "low")
            .when(F.abs(split - total) <= tol.amount_eur, "low").otherwise("medium"),
            evidence={"loan_amount": money(amount), "scheduled_principal": money(scheduled),
                      "settlement_cash": money(settled), "summary_principal_total": money(split),
                      "gap": money(b1)},
        ),
        "B2": Check(
            F.abs(b2) > tol.amount_eur,
            text("outstanding plus repaid principal misses the loan amount by ", eur_text(F.abs(b2))),
            [(_any_null("loan_amount", "outstanding_principal", "repaid_principal"),
              "principal_split_missing", True)],
            evidence={"loan_amount": money(amount), "gap": money(b2)},
        ),
        "B3": Check(
            F.abs(b3) > tol.amount_eur,
            text("payment records show ", eur_text(euros(c("m_principal_paid"))),
                 " principal paid, the summary ", eur_text(c("repaid_principal"))),
            [*whole, (c("repaid_principal").isNull(), "repaid_principal_missing", True),
             (c("m_principal_paid").isNull(), "sum_beyond_range", True)],
            evidence={"diary_paid_principal": money(euros(c("m_principal_paid"))),
                      "repaid_principal": money(c("repaid_principal")), "gap": money(b3)},
        ),
        "B4": interest("Repaid interest", "repaid_interest", "m_interest_paid", "interest paid"),
        "B5": interest("Outstanding interest", "outstanding_interest", "m_interest_pending",
                       "interest still open"),
        "B6": interest("Delay interest", "delay_interest", "m_overdue_paid", "overdue interest paid"),
        "B7": Check(
            ~(close | F.coalesce(claims, F.lit(False))),
            text("summary says ", c("days_late"), " days late, the oldest open instalment is ", overdue,
                 " days past due"),
            [*_diary_skips(), (c("days_late").isNull(), "days_late_missing", True),
             (c("diary_truncated") & (c("n_overdue") == 0), "diary_truncated", False)],
            evidence={"days_late": c("days_late"), "diary_days_past_due": overdue,
                      "termination_claim_days_past_due": F.array_max("claim_days"),
                      "as_of": F.lit(as_of)},
        ),
        "B11": Check(
            ~F.coalesce(fits, F.lit(False)),
            text("expected repayment lies ", months(c("expected_repayment_date")),
                 " months after disbursal, the term is ", c("loan_term_months")),
            [(_any_null("disbursal_date", "expected_repayment_date", "loan_term_months"),
              "term_dates_missing", True)],
            evidence={"disbursal_date": c("disbursal_date"),
                      "expected_repayment_date": c("expected_repayment_date"),
                      "loan_term_months": c("loan_term_months"),
                      "implied_months": months(c("expected_repayment_date"))},
        ),
    }


def _rate_check(policy: Policy, as_of: date) -> Check:
    c, cfg, tol = F.col, policy.irr, policy.tolerance
    live = F.coalesce(c("loan_status") == "granted", F.lit(False))
    deferred = F.coalesce(c("loan_type") == "deferred annuity", F.lit(False))
    realised = c("xirr") * 100.0
    gap = realised - c("interest_rate")
    threshold = F.greatest(F.lit(cfg.gap_percentage_points), cfg.gap_relative * F.abs("interest_rate"))
    nothing_paid = euros(c("m_any_interest_paid")) <= tol.interest_eur
    settled = F.coalesce("repayment_date", "last_paid")
    fell_due = F.coalesce(c("first_interest_due") < settled, F.lit(False))
    early = c("expected_repayment_date").isNull() | (settled < c("expected_repayment_date"))
    trust = (
        F.when(~deferred, "high").when(settled.isNull(), "medium")
        .when(early & ~fell_due, "low").when(early, "medium").otherwise("high")
    )
    principal_gap = euros(F.try_add("m_schedule", "m_settlement")) - c("loan_amount")
    shortfall = (gap < 0) & (principal_gap < -tol.amount_eur)
    confidence = F.when(shortfall, "low").otherwise(trust)
    on_schedule = c("xirr_on_schedule") * 100.0
    timing = (gap < 0) & F.coalesce(F.abs(on_schedule - c("interest_rate")) <= threshold, F.lit(False))
    independent = (
        ~shortfall & (confidence != "low")
        & ((gap > 0) | nothing_paid | (on_schedule.isNotNull() & ~timing))
    )
    outside = (c("first_cash") < c("disbursal_date")) | (c("last_cash") > F.lit(as_of))
    thin = (c("m_interest_open_all") <= 0) | (
        F.try_divide("m_interest_open_paid", "m_interest_open_all") < cfg.min_realised_interest_share)
    return Check(
        F.abs(gap) > threshold,
        text("stated rate ", c("interest_rate"), " % against a realised ", F.round(realised, 1), " %",
             F.when(timing, "; receipts moved to schedule explain the gap").otherwise(""),
             F.when(shortfall, "; linked to a principal shortfall").otherwise("")),
        [*_diary_skips(),
         (_any_null("loan_amount", "interest_rate", "disbursal_date"), "rate_inputs_missing", True),
         (c("n_cash_undated") > 0, "undated_receipts", True),
         (F.coalesce(outside, F.lit(False)), "receipts_out_of_bounds", False),
         (c("n_cash") < cfg.min_inflows, "too_few_flows", False),
         (live & deferred, "live_deferred_annuity", False),
         (c("diary_truncated"), "diary_truncated", False),
         (live & F.coalesce(thin, F.lit(True)), "little_interest_realised", False),
         (live & c("outstanding_principal").isNull(), "no_terminal_value", False),
         (_any_null("m_any_interest_paid") | F.try_add("m_schedule", "m_settlement").isNull(), "sum_beyond_range", True),
         (c("xirr").isNull(), "no_convergence", True)],
        severity=F.when(confidence == "low", "low")
        .when((F.abs(gap) > 2 * threshold) | nothing_paid, "high").otherwise("medium"),
        standalone=independent,
        evidence={"stated_rate_pct": c("interest_rate"), "realised_xirr_pct": F.round(realised, 2),
                  "gap_pct_points": F.round(gap, 2), "threshold_pct_points": F.round(threshold, 2),
                  "confidence": confidence, "principal_gap": money(principal_gap),
                  "on_schedule_xirr_pct": F.round(on_schedule, 2), "timing_explains_gap": timing,
                  "independent_rate_evidence": independent},
    )


def _arithmetic(policy: Policy, as_of: date) -> dict[str, Check]:
    c, tol = F.col, policy.tolerance
    diary = _diary_skips()
    broad = (c("interest_missed") >= 2) & (c("interest_missed") / c("interest_checked") > 0.5)
    isolated = ~F.coalesce(broad, F.lit(False)) & (c("interest_isolated") > 0)
    fields = (
        ("Loan amount", "loan_amount"), ("Outstanding principal", "outstanding_principal"),
        ("Repaid principal", "repaid_principal"), ("Outstanding interest", "outstanding_interest"),
        ("Repaid interest", "repaid_interest"), ("Monthly payment", "monthly_payment"),
        ("Arrears", "arrears"), ("Delay interest", "delay_interest"), ("Days late", "days_late"),
    )
    negative = F.array_compact(F.array(*[F.when(c(n) < 0, F.lit(f)) for f, n in fields]))
    contradiction = (c("n_paid_with_pending") > 0) | (c("n_open_above") > 0)
    return {
        "C1": Check(
            broad | isolated,
            F.when(isolated, text("one instalment's interest, due ", c("interest_first_isolated"),
                                  ", exceeds every accrual bound while its neighbours fit"))
            .otherwise(text(c("interest_missed"), " of ", c("interest_checked"),
                            " interest instalments differ from balance x rate / 12, first due ",
                            c("interest_first_miss"))),
            [*_diary_skips(True),
             (_any_null("loan_amount", "interest_rate"), "accrual_inputs_missing", True),
             (F.coalesce(c("loan_type") == "deferred annuity", F.lit(False)), "deferred_annuity", False),
             (c("n_principal_undated") > 0, "undated_principal_receipt", True),
             (c("interest_checked") < 2, "too_few_instalments", False)],
            standalone=isolated,
            evidence={"stated_rate_pct": c("interest_rate"), "instalments_checked": c("interest_checked"),
                      "instalments_off": F.when(isolated, c("interest_isolated")).otherwise(
                          c("interest_missed")),
                      "first_due": F.coalesce(F.when(isolated, c("interest_first_isolated")),
                                              c("interest_first_miss"))},
        ),
        "C2": _rate_check(policy, as_of),
        "C4": Check((F.size(negative) > 0) | (c("n_negative") > 0),
                    text("negative values: ", F.array_join(negative, ", "), " and ", c("n_negative"),
                         " payment records"),
                    evidence={"summary_fields": F.array_join(negative, ", "),
                              "negative_diary_rows": c("n_negative")}),
        "C5": Check(c("n_pending_above") > 0,
                    text(c("n_pending_above"), " records owe more than their amount"), diary,
                    evidence={"rows": c("n_pending_above")}),
        "C6": Check(contradiction | (c("n_open_part") > 0),
                    text(c("n_paid_with_pending"), " paid records still show a remainder, ",
                         c("n_open_above"), " open records owe more than their amount, ",
                         c("n_open_part"), " open records are part-paid (", c("n_open_part_undated"),
                         " without a date)"),
                    diary, severity=F.when(contradiction, "high").otherwise("low"),
                    evidence={"paid_with_pending": c("n_paid_with_pending"),
                              "pending_above_amount": c("n_open_above"),
                              "part_paid_open_rows": c("n_open_part")}),
        "C8": Check(c("unpaid_streak") >= 3,
                    text("the last ", c("unpaid_streak"), " principal instalments are unpaid, since ",
                         c("unpaid_since")),
                    [*diary, (~F.coalesce(c("loan_status") == "granted", F.lit(False)), "not_live", False)],
                    evidence={"unpaid_consecutive": c("unpaid_streak"), "since": c("unpaid_since")}),
        "C9": Check((c("n_zero_paid") > 0) | (c("n_duplicate") > 0),
                    text(c("n_zero_paid"), " paid records of zero and ", c("n_duplicate"),
                         " identical copies"),
                    diary, evidence={"zero_amount_paid_rows": c("n_zero_paid"),
                                     "duplicate_rows": c("n_duplicate")}),
        "C10": Check(c("slot_conflicts") > 0,
                     text(c("slot_conflicts"), " due-date slots hold several different records of one type"),
                     diary, severity=F.when(c("slot_conflict_open"), "medium").otherwise("low"),
                     evidence={"slots_total": c("slot_conflicts")}),
    }


def _temporal(policy: Policy, as_of: date) -> dict[str, Check]:
    c, tol = F.col, policy.tolerance
    diary = _diary_skips()
    no_disbursal = (c("disbursal_date").isNull(), "disbursal_missing", True)
    first_reading = F.array_min("disbursal_readings")
    earliest = F.least("first_due", "first_actual")
    backwards = lambda readings: F.coalesce(
        F.array_max(readings) < first_reading, F.lit(False))
    wrong = F.array_compact(F.array(
        F.when(backwards("repayment_readings"), F.lit("Repayment date")),
        F.when(backwards("expected_readings"), F.lit("Expected repayment date")),
    ))
    grace_days, label_days = X.worst_days(c("w_stale_grace")), X.worst_days(c("w_mislabelled"))
    return {
        "D1": Check(earliest < first_reading,
                    text("payment dates start on ", earliest, ", before disbursal ", c("disbursal_date")),
                    [*diary, no_disbursal],
                    evidence={"disbursal_date": c("disbursal_date"), "earliest": earliest}),
        "D2": Check(c("n_future_paid") > 0,
                    text(c("n_future_paid"), " records are paid after ", F.lit(as_of), ", up to ",
                         c("last_paid")),
                    diary, evidence={"as_of": F.lit(as_of), "latest_paid": c("last_paid"),
                                     "count": c("n_future_paid")}),
        "D3": Check((c("schedule_gaps") > 0) | (c("schedule_doubles") > 0),
                    text("principal dates leave ", c("schedule_gaps"), " gaps and ", c("schedule_doubles"),
                         " doubles"),
                    [*diary, (c("principal_dates") < 3, "too_few_dates", False)],
                    evidence={"gaps": c("schedule_gaps"), "doubles": c("schedule_doubles")}),
        "D4": Check(c("last_paid") > F.date_add(F.array_max("repayment_readings"),
                                                tol.repayment_date_slack_days),
                    text("last payment ", c("last_paid"), " follows the repayment date ",
                         c("repayment_date")),
                    [*diary, (c("repayment_date").isNull(), "repayment_date_missing", True),
                     (c("last_paid").isNull(), "nothing_paid", False)],
                    evidence={"last_paid": c("last_paid"), "repayment_date": c("repayment_date")}),
        "D5": Check(F.size(wrong) > 0, text(F.array_join(wrong, ", "), " before disbursal ",
                                            c("disbursal_date")),
                    [no_disbursal], evidence={"disbursal_date": c("disbursal_date"),
                                              "fields": F.array_join(wrong, ", ")}),
        "D6": Check(c("n_stale_grace") > 0,
                    text(c("n_stale_grace"), " records claim a grace period although ", grace_days,
                         " days past due"),
                    diary, evidence={"rows": c("n_stale_grace"), "days_past_due": grace_days,
                                     "oldest_due": X.worst_due(c("w_stale_grace"))}),
        "D7": Check(c("n_early") > 0,
                    text(c("n_early"), " instalments were paid up to ", -c("min_delay"),
                         " days early without an early-repayment event"),
                    diary, evidence={"rows": c("n_early"), "earliest_days": c("min_delay")}),
        "D8": Check(c("n_mislabelled") > 0,
                    text(c("n_mislabelled"), " records are labelled on time but were up to ", label_days,
                         " days late"),
                    diary, evidence={"rows": c("n_mislabelled"), "worst_delay_days": label_days,
                                     "worst_due": X.worst_due(c("w_mislabelled"))}),
    }


def _lifecycle(policy: Policy, missing: frozenset[str]) -> dict[str, Check]:
    c, tol = F.col, policy.tolerance
    diary = _diary_skips()
    usable = c("diary_error").isNull() & (c("n_records") > 0)
    status = lambda s: F.coalesce(c("loan_status") == s, F.lit(False))
    no_date = c("repayment_date").isNull() & ~_absent(missing, "Repayment date")
    owes = F.coalesce(c("outstanding_principal") > tol.amount_eur, F.lit(False))
    flat = F.coalesce(F.abs("outstanding_principal") <= tol.amount_eur, F.lit(False))
    all_paid = usable & ~c("diary_truncated") & (c("n_open") == 0)
    unresolved = euros(F.try_add("m_open", "m_claim"))
    bare = (c("n_termination") == 0) & (c("n_open") == 0)
    still_open = text(c("n_open"), " components on ", c("due_open"), " due dates, ",
                      eur_text(euros(c("m_open"))))
    return {
        "E1": Check(owes | no_date | (usable & (c("n_open") > 0)),
                    text("marked repaid",
                         F.when(owes, text(", outstanding ", eur_text(c("outstanding_principal"))))
                         .otherwise(""),
                         F.when(no_date, ", no repayment date").otherwise(""),
                         F.when(c("n_open") > 0, text(", still open: ", still_open)).otherwise("")),
                    [(~status("repaid"), "not_repaid", False)],
                    evidence={"loan_status": c("loan_status"), "unpaid_components": c("n_open"),
                              "unpaid_due_dates": c("due_open"), "unpaid_amount": money(euros(c("m_open")))}),
        "E2": Check(c("repayment_date").isNotNull() | flat | all_paid,
                    text("marked granted",
                         F.when(c("repayment_date").isNotNull(),
                                text(", repayment date ", c("repayment_date"))).otherwise(""),
                         F.when(flat, ", nothing outstanding").otherwise(""),
                         F.when(all_paid, ", every instalment paid").otherwise("")),
                    [(~status("granted"), "not_live", False)],
                    evidence={"loan_status": c("loan_status"), "unpaid_components": c("n_open")}),
        "E3": Check(bare | (unresolved > tol.amount_eur),
                    F.when(bare, text("marked terminated without a termination record or open instalment"))
                    .otherwise(text("terminated with ", eur_text(unresolved), " unresolved")),
                    [(~status("terminated"), "not_terminated", False), *diary, (~bare & unresolved.isNull(), "sum_beyond_range", True)],
                    evidence={"loan_status": c("loan_status"), "unresolved_amount": money(unresolved),
                              "unpaid_components": c("n_open"), "pending_termination_rows": c("n_claim")}),
        "E4": Check((c("n_paid_undated") > 0) | (c("n_unpaid_dated") > 0),
                    text(c("n_paid_undated"), " paid records lack a date, ", c("n_unpaid_dated"),
                         " unpaid records carry one"),
                    diary, evidence={"paid_without_date": c("n_paid_undated"),
                                     "unpaid_with_date": c("n_unpaid_dated")}),
        "E5": Check(c("n_open") > 0,
                    text("settled early on ", c("closing_date"), " but still open: ", still_open),
                    [*diary, (c("closing_date").isNull(), "no_full_settlement", False)],
                    evidence={"full_early_repayment_date": c("closing_date"),
                              "pending_components": c("n_open"), "pending_due_dates": c("due_open"),
                              "pending_amount": money(euros(c("m_open")))}),
    }


def _credit(policy: Policy) -> dict[str, Check]:
    c, late = F.col, policy.lateness
    diary = _diary_skips()
    unusable = [((c("diary_error").isNotNull()) | (c("n_records") == 0), "diary_unusable", False)]
    live = F.coalesce(c("loan_status") == "granted", F.lit(False))
    worst = X.worst_days(c("w_delay"))
    oldest = X.worst_days(c("w_overdue"))
    band_paid, band_open = X.worst_days(c("w_late_band")), X.worst_days(c("w_overdue_band"))
    band_worst = F.greatest(band_paid, band_open)
    share = F.try_divide(c("n_paid_late"), c("n_paid_delays"))
    need = max(late.trend_min_paid, late.drift_recent_episodes + 1)
    return {
        "F1": Check(c("n_late_default") > 0,
                    text(c("n_late_default"), " components on ", c("due_late_default"), " due dates paid ",
                         late.default_days, " or more days late, worst ", worst, " days (due ",
                         X.worst_due(c("w_delay")), ")"),
                    diary, severity=F.when(live, "critical").otherwise("high"),
                    evidence={"components_90_plus": c("n_late_default"),
                              "due_dates_90_plus": c("due_late_default"), "worst_delay_days": worst,
                              "worst_due": X.worst_due(c("w_delay")),
                              "worst_paid": F.date_add(X.worst_due(c("w_delay")), worst)}),
        "F2": Check(c("n_overdue_default") > 0,
                    text(c("n_overdue_default"), " components on ", c("due_overdue_default"),
                         " due dates with ", eur_text(euros(c("m_overdue_default"))), " unpaid for ",
                         late.default_days, " or more days, oldest ", oldest, " days (due ",
                         X.worst_due(c("w_overdue")), ")"),
                    diary,
                    evidence={"components_overdue": c("n_overdue_default"),
                              "due_dates_overdue": c("due_overdue_default"),
                              "overdue_amount": money(euros(c("m_overdue_default"))),
                              "oldest_days_past_due": oldest, "oldest_due": X.worst_due(c("w_overdue")),
                              "loan_status": c("loan_status")}),
        "F3": Check((c("n_late_band") > 0) | (c("n_overdue_band") > 0),
                    text(c("n_late_band"), " components paid and ", c("n_overdue_band"), " still open ",
                         late.medium_days, "-", late.default_days - 1, " days late, worst ", band_worst),
                    diary,
                    severity=F.when((c("n_overdue_band") > 0) | (band_worst >= late.watch_flag_days),
                                    "medium").otherwise("low"),
                    evidence={"worst_days": band_worst, "paid_late_count": c("n_late_band"),
                              "unpaid_count": c("n_overdue_band")}),
        "G6": Check(F.round(share, 3) >= late.habitual_late_share,
                    text(c("n_paid_late"), " of ", c("n_paid_delays"), " payments late, median ",
                         c("median_delay_days"), ", worst ", worst, ", trend ", c("trend_days"), " days"),
                    [*unusable, (c("n_paid_delays") < late.trend_min_paid, "too_few_payments", False)],
                    evidence={"paid_late_share": F.round(share, 3), "median_delay_days": c("median_delay_days"),
                              "worst_delay_days": worst, "trend_days": c("trend_days")}),
        "G7": Check(worst.isNotNull() & (oldest > F.greatest(worst, F.lit(late.grace_days))),
                    text("an instalment is ", oldest, " days past due, beyond the borrower's own worst of ",
                         worst),
                    [*unusable, (~live, "not_live", False)],
                    evidence={"current_max_days_past_due": oldest, "historical_worst_days": worst}),
        "G8": Check(c("recent_exceeding") >= late.drift_min_exceeding,
                    text("after ", c("episodes") - late.drift_recent_episodes, " punctual due dates ",
                         c("recent_exceeding"), " of the last ", late.drift_recent_episodes, " ran late"),
                    [*unusable, (c("episodes") < need, "too_few_episodes", False),
                     (c("baseline_worst") > late.grace_days, "irregular_baseline", False)],
                    evidence={"baseline_episodes": c("episodes") - late.drift_recent_episodes,
                              "baseline_worst_days": c("baseline_worst"),
                              "recent_exceeding": c("recent_exceeding")}),
    }


def _plausibility(policy: Policy, missing: frozenset[str]) -> dict[str, Check]:
    c, p = F.col, policy.plausibility
    business = (F.coalesce(c("borrower_type") == "business", F.lit(False)), "business_borrower", False)
    age = F.year("disbursal_date") - c("birth_year")
    income = F.coalesce(F.when(c("family_income") != 0, c("family_income")), c("borrower_income"))
    ratio = F.try_divide("monthly_payment", income)
    off = F.array_compact(F.array(
        F.when(~c("interest_rate").between(p.min_interest_rate, p.max_interest_rate), F.lit("Interest rate")),
        F.when(~c("loan_term_months").between(p.min_term_months, p.max_term_months), F.lit("Loan term")),
        F.when(c("loan_amount") <= 0, F.lit("Loan amount")),
    ))
    people = (("Family income", "family_income"), ("Borrower income", "borrower_income"),
              ("Family liabilities", "family_liabilities"), ("Children", "children"),
              ("Company age (years)", "company_age_years"))
    negative = F.array_compact(F.array(*[F.when(c(n) < 0, F.lit(f)) for f, n in people]))
    return {
        "H1": Check(~age.between(p.min_age, p.max_age),
                    text("age at disbursal outside ", p.min_age, "-", p.max_age),
                    [business, (_any_null("birth_year", "disbursal_date"), "birth_year_missing", False)],
                    evidence={"field": F.lit("Birth year")}),
        "H3": Check(ratio > p.max_payment_to_income,
                    text("monthly payment is ", F.round(ratio, 2), " of monthly income"),
                    [business, (income.isNull() | (income == 0) | c("monthly_payment").isNull(),
                                "income_missing", False)],
                    evidence={"payment_to_income": F.round(ratio, 2), "limit": F.lit(p.max_payment_to_income),
                              "confidence": F.lit("low")}),
        "H4": Check(((c("borrower_type") == "individual") & c("birth_year").isNull())
                    | ((c("borrower_type") == "business") & c("birth_year").isNotNull()),
                    text("birth year does not fit the borrower type"),
                    [(c("borrower_type").isNull() | _absent(missing, "Birth year"),
                      "borrower_fields_missing", False)],
                    evidence={"field": F.lit("Birth year")}),
        "H5": Check(F.size(off) > 0, text("outside the product range: ", F.array_join(off, ", ")),
                    evidence={"fields": F.array_join(off, ", ")}),
        "H9": Check(F.size(negative) > 0, text("negative: ", F.array_join(negative, ", ")),
                    evidence={"fields": F.array_join(negative, ", ")}),
        "H10": Check((c("employment_status") == "unemployed") & (c("borrower_income") > 0),
                     text("unemployed with a positive income"),
                     [(_any_null("employment_status", "borrower_income"), "employment_missing", False)],
                     evidence={"fields": F.lit("Employment status, Borrower income"),
                               "confidence": F.lit("low")}),
    }


def checks(policy: Policy, missing: frozenset[str], as_of: date,
           only: list[str] | None = None) -> dict[str, Check]:
    """Checks by rule id; only the families that ``only`` touches are built."""
    families = {
        "A": lambda: _readability(policy, missing), "B": lambda: _identity(policy, missing, as_of),
        "C": lambda: _arithmetic(policy, as_of), "D": lambda: _temporal(policy, as_of),
        "E": lambda: _lifecycle(policy, missing), "F": lambda: _credit(policy),
        "H": lambda: _plausibility(policy, missing),
    }
    wanted = {("F" if i[0] == "G" else i[0]) for i in (only or list(BY_ID))}
    built: dict[str, Check] = {}
    for family in sorted(wanted):
        built.update(families[family]())
    return built


PASSED, FAILED, FIRST_SKIP = 0, 1, 2


def _status(check: Check) -> Column:
    """``PASSED``, ``FAILED``, or ``FIRST_SKIP`` and more: the number of the reason not to evaluate the check. A plain
    number is computed once a row, however many columns read it; a struct would be taken apart and computed for each."""
    failed = F.when(check.fail, FAILED).otherwise(PASSED)
    code = None
    for i, (condition, _, _) in enumerate(check.skips, start=FIRST_SKIP):
        code = F.when(condition, i) if code is None else code.when(condition, i)
    return failed if code is None else code.otherwise(failed)


def _reason(rule_id: str, check: Check) -> Column:
    code = F.lit(None).cast("string")
    for i, (_, reason, _) in enumerate(check.skips, start=FIRST_SKIP):
        code = F.when(F.col(f"_s_{rule_id}") == i, reason).otherwise(code)
    return code


def _missing(rule_id: str, check: Check) -> Column:
    codes = [i for i, (_, _, missing) in enumerate(check.skips, start=FIRST_SKIP) if missing]
    missing = F.col(f"_s_{rule_id}").isin(*codes) if codes else F.lit(False)
    if rule_id == "D4":
        missing = missing & F.coalesce(F.col("loan_status") == "repaid", F.lit(False))
    return missing


def _abstains(rule_id: str) -> Column:
    return F.col(f"_s_{rule_id}") >= FIRST_SKIP


def _fires(rule_id: str) -> Column:
    return F.col(f"_s_{rule_id}") == FAILED


def _severity(rule_id: str, check: Check, policy: Policy) -> Column:
    default = F.lit(BY_ID[rule_id].severity)
    if rule_id in policy.info_only_rules:
        return F.lit("info")
    return default if check.severity is None else F.coalesce(check.severity, default)


def _rank(rule_id: str, check: Check, policy: Policy) -> Column:
    severity = _severity(rule_id, check, policy)
    return (F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity) - 1).cast("int")


def _cause(rule_id: str, check: Check, ids: list[str]) -> Column:
    """The first failed rule that explains this one's failure, NULL if none does or it stands alone."""
    cause = F.lit(None).cast("string")
    for other in reversed([i for i in BY_ID[rule_id].subsumed_by if i in ids]):
        cause = F.when(_fires(other), other).otherwise(cause)
    return cause if check.standalone is None else F.when(~F.coalesce(check.standalone, F.lit(False)), cause)


def _fired(rule_id: str, check: Check, policy: Policy, told: bool) -> Column:
    """All that is known of a failed check, NULL otherwise; metadata is literal. Message and evidence are made only where
    they are ``told``."""
    info = BY_ID[rule_id]
    pairs = [x for k, v in check.evidence.items() for x in (F.lit(k), v.cast("string"))]
    fixed = FIXED_MESSAGES.get(rule_id)
    words = [check.message.alias("message"), (F.lit(fixed) if fixed else check.message).alias("shown"),
             F.create_map(*pairs).alias("evidence")] if told else []
    cause = F.col(f"_c_{rule_id}")
    return F.when(_fires(rule_id), F.struct(
        F.lit(rule_id).alias("rule_id"), F.lit(info.category).alias("category"), F.lit(info.axis).alias("axis"),
        F.lit(info.group).alias("group"), _severity(rule_id, check, policy).alias("severity"),
        F.col(f"_k_{rule_id}").alias("rank"), F.lit(ORDINAL[rule_id]).alias("ordinal"), *words,
        cause.isNull().alias("root_cause"), cause.alias("symptom_of"),
    ))


def _any(flags: list[Column]) -> Column:
    return reduce(or_, flags, F.lit(False))


def _worst(ranks: list[Column]) -> Column:
    none = F.lit(None).cast("int")
    return F.greatest(none, none, *ranks)


def _summary(ids: list[str]) -> dict[str, Column]:
    """What is told of all failed checks of a loan together. Every rule has its own columns, so that no array is built,
    filtered or sorted for it."""
    fires, rank = {i: _fires(i) for i in ids}, {i: F.col(f"_k_{i}") for i in ids}
    reported = {i: fires[i] & (rank[i] > 0) for i in ids}
    root = {i: reported[i] & F.col(f"_c_{i}").isNull() for i in ids}
    axes, groups = {i: BY_ID[i].axis for i in ids}, {i: BY_ID[i].group for i in ids}
    count = lambda flags: sum((F.when(f, 1).otherwise(0) for f in flags.values()), F.lit(0))
    worst = lambda flags, *only: _worst([F.when(f, rank[i]) for i, f in flags.items() if axes[i] in (only or axes.values())])
    named = lambda of, flags: [F.when(_any([f for i, f in flags.items() if of[i] == x]), x) for x in sorted({x for x in of.values() if x})]
    return {
        "_worst_root": worst(root), "_worst_integrity_root": worst(root, "integrity"), "_worst": worst(reported),
        "_worst_integrity": worst(reported, "integrity"), "reported_count": count(reported), "root_count": count(root),
        "rule_ids": F.concat_ws(";", *[F.when(f, i) for i, f in fires.items()]),
        "root_axes": F.concat_ws("+", *named(axes, root)), "finding_groups": F.concat_ws(";", *named(groups, fires)),
        "credit_event": F.when(_any([fires[i] for i in DEFAULT_RULES if i in ids]), "default")
        .when(_any([fires[i] for i in WATCH_RULES if i in ids]), "watch").otherwise("none"),
    }


def _enabled(policy: Policy, only: list[str] | None = None) -> list[str]:
    return [r.rule_id for r in RULES if r.rule_id not in policy.disabled_rules
            and (only is None or r.rule_id in only)]


def status_columns(assessed: DataFrame, policy: Policy, missing: frozenset[str], as_of: date,
                   only: list[str], keep: list[str]) -> DataFrame:
    """One text column per rule: ``pass``, ``not_evaluable`` or ``fail:<severity>``."""
    built = checks(policy, missing, as_of, only)
    ids = _enabled(policy, only)
    staged = assessed.select("*", *[_status(built[i]).alias(f"_s_{i}") for i in ids])
    return staged.select(*keep, *[
        F.when(_abstains(i), "not_evaluable")
        .when(_fires(i), F.concat(F.lit("fail:"), _severity(i, built[i], policy)))
        .otherwise("pass").alias(i) for i in ids])


def evaluate(assessed: DataFrame, policy: Policy, missing: frozenset[str], as_of: date,
             keep: list[str], told: bool = True) -> DataFrame:
    """All enabled rules of a loan: the ``outcomes`` array in evaluation order, the ``findings`` array of failed
    checks with message and evidence (if ``told``) and the first failed rule that explains each, unless it stands alone;
    the three counts, whether evidence was missing, and the summary of the findings."""
    built = checks(policy, missing, as_of)
    ids = _enabled(policy)
    staged = assessed.select("*", *[_status(built[i]).alias(f"_s_{i}") for i in ids])
    staged = staged.select("*", *[_rank(i, built[i], policy).alias(f"_k_{i}") for i in ids],
                           *[_cause(i, built[i], ids).alias(f"_c_{i}") for i in ids])
    count = lambda flag: sum((flag(i).cast("int") for i in ids), F.lit(0))
    gap = F.lit(False)
    for i in ids:
        if BY_ID[i].category in EVIDENCE_CATEGORIES:
            gap = gap | _missing(i, built[i])
    return staged.select(
        *keep,
        F.array(*[F.struct(
            F.lit(i).alias("rule_id"),
            F.when(_abstains(i), "not_evaluable").when(_fires(i), "fail").otherwise("pass")
            .alias("status"),
            _reason(i, built[i]).alias("reason_code"), _missing(i, built[i]).alias("missing_evidence"),
        ) for i in ids]).alias("outcomes"),
        F.array_compact(F.array(*[_fired(i, built[i], policy, told) for i in ids])).alias("findings"),
        count(lambda i: F.col(f"_s_{i}") == PASSED).alias("checks_passed"),
        count(_fires).alias("checks_failed"), count(_abstains).alias("checks_not_evaluable"),
        gap.alias("evidence_gap"), *[column.alias(name) for name, column in _summary(ids).items()],
    )
