"""Whole-tape checks I1-I6. Each yields one row (status, message, evidence); counting is always done on
pre-aggregated keys, and lists in evidence are explicit top-k reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.config import LOAN_STATUSES, LOAN_TYPES, Policy
from tape_audit.functions import digits
from tape_audit.functions.money import cents
from tape_audit.operators import conventions as C
from tape_audit.plans.judgement import public_category
from tape_audit.plans.ledger import KEY
from tape_audit.plans.rules import text

BALANCES = ("monthly_payment", "outstanding_principal", "repaid_interest", "outstanding_interest",
            "arrears", "delay_interest")


ROW_IDENTITY = ["due_date", "actual_date", "type", "cents"]


# ---- facts ----------------------------------------------------------------------------------------

def paid_rows(payments: DataFrame) -> DataFrame:
    """State-paid records with a positive amount, amounts in cents."""
    return payments.filter((F.col("is_paid")) & (F.col("amount") > 0)).withColumn(
        "cents", cents(F.col("amount")))


def distinct_paid_cents(payments: DataFrame) -> DataFrame:
    """Each paid amount once per loan: an annuity repeats its instalment, that is one number."""
    return paid_rows(payments).select(*KEY, "loan_id", "cents").dropDuplicates([*KEY, "cents"])


def free_cents(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Amounts nobody chose: paid interest and settlements, open remainders, summary balances."""
    paid = paid_rows(payments).filter(F.col("type").isin(*C.INTEREST, *C.EARLY, C.TERMINATION))
    pending = payments.filter("pending_amount > 0")
    balances = loans.select(F.explode(F.array(*BALANCES)).alias("v")).filter("v > 0")
    return (
        paid.select("cents", "copies")
        .unionByName(pending.select(cents(F.col("pending_amount")).alias("cents"), "copies"))
        .unionByName(balances.select(cents(F.col("v")).alias("cents"),
                                     F.lit(1).cast("bigint").alias("copies")))
    )


def borrower_facts(loans: DataFrame, lender: str = "default") -> DataFrame:
    """Lender-scoped digests: comparable within a lender, never the identity itself."""
    c = F.col
    return loans.filter("borrower_id IS NOT NULL").select(
        *KEY, "loan_id",
        F.sha2(F.concat_ws("\x1f", F.lit("borrower"), F.lit(lender), c("borrower_id")), 256).alias("token"),
        F.sha2(F.concat_ws("\x1f", F.lit("demographics"), F.lit(lender), c("borrower_id"),
                           F.coalesce(c("birth_year").cast("string"), F.lit("\x00")),
                           F.coalesce(c("borrower_type"), F.lit("\x00"))), 256).alias("demographics"),
    )


@dataclass(frozen=True)
class TapeFacts:
    """All that the whole-tape checks need, in tables that several batches of one tape may simply put together:
    ``loans`` with digests instead of identities, ``paid`` records folded by what identifies them, and ``rounds``, one
    row of counters for each batch."""

    loans: DataFrame
    paid: DataFrame
    rounds: DataFrame

    @property
    def amounts(self) -> DataFrame:
        """Each paid amount once per loan."""
        return self.paid.select(*KEY, "loan_id", "cents").dropDuplicates([*KEY, "cents"])


def tape_facts(loans: DataFrame, payments: DataFrame, policy: Policy) -> TapeFacts:
    c = F.col
    people = borrower_facts(loans, policy.lender).select(*KEY, "token", "demographics")
    narrow = loans.select(*KEY, "loan_id", public_category(c("loan_status"), LOAN_STATUSES).alias("loan_status"),
                          public_category(c("loan_type"), LOAN_TYPES).alias("loan_type"), "disbursal_date", "days_late")
    paid = paid_rows(payments).groupBy(*KEY, "loan_id", *ROW_IDENTITY).agg(F.sum("copies").alias("copies"))
    return TapeFacts(narrow.join(people, KEY, "left"), paid, round_share(free_cents(loans, payments)))


# ---- generic operators ----------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def conflicting_attributes(df: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys seen with more than one attribute digest. Minimum and maximum decide, so nothing is collected."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), (F.min(digest) != F.max(digest)).alias("conflicting"))


def shared_rows(df: DataFrame, cols: list[str], owner: str) -> DataFrame:
    """Row values that occur under two or more owners, with the number of owners. Copies within one owner
    are folded first; a value held by a third of all rows is then one counter per map task."""
    pairs = df.select(*cols, owner).distinct()
    return pairs.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("owners"), F.min(owner).alias("first_owner"), F.max(owner).alias("last_owner")
    ).filter("owners > 1")


def shared_row_members(df: DataFrame, cols: list[str], owner: str) -> DataFrame:
    """Long form: every (row value, owner) pair of the shared rows, so no owner list is ever gathered. NULL in a
    column is a value like any other."""
    pairs = df.select(*cols, owner).distinct()
    shared = shared_rows(df, cols, owner).select(*(F.col(c).alias(f"_{c}") for c in cols))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
    return pairs.join(shared, same, "left_semi")


def round_share(df: DataFrame) -> DataFrame:
    """Share of amounts without cents; amounts below one euro do not count."""
    n = F.sum("copies")
    return df.filter("cents >= 100").agg(
        F.coalesce(n, F.lit(0)).alias("computed_amounts"),
        F.coalesce(F.sum(F.when(F.col("cents") % 100 == 0, F.col("copies")).otherwise(0)), F.lit(0))
        .alias("round_amounts"),
    )


# ---- checks ---------------------------------------------------------------------------------------

def _check(df: DataFrame, rule: str, title: str, severity: str, status: Column, message: Column,
           evidence: dict[str, Column]) -> DataFrame:
    pairs = [x for k, v in evidence.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        F.lit(rule).alias("rule_id"), F.lit(title).alias("title"), F.lit("whole_tape").alias("group"),
        status.alias("status"), F.lit(severity).alias("severity"), message.alias("message"),
        F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("evidence"),
    )


def duplicate_ids_check(loans: DataFrame) -> DataFrame:
    counts = loans.groupBy("loan_id").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.agg(F.count(F.lit(1)).alias("ids"), F.count_if(F.col("n") > 1).alias("dupes"),
                       F.min(F.when(F.col("n") > 1, F.col("loan_id"))).alias("example"))
    c = F.col
    return _check(
        stats, "I1", "Loan IDs are unique", "critical",
        F.when(c("dupes") > 0, "fail").otherwise("pass"),
        text(c("dupes"), " of ", c("ids"), " loan IDs are repeated"),
        {"distinct_loan_ids": c("ids"), "count": c("dupes"), "example": c("example")})


def demographics_check(people: DataFrame) -> DataFrame:
    per = conflicting_attributes(people.filter("token IS NOT NULL"), "token", "demographics")
    stats = per.agg(F.count(F.lit(1)).alias("borrowers"), F.count_if(F.col("rows") > 1).alias("several"),
                    F.count_if("conflicting").alias("bad"))
    c = F.col
    return _check(
        stats, "I2", "A borrower carries the same demographics on every loan", "high",
        F.when(c("borrowers") == 0, "not_evaluable").when(c("bad") > 0, "fail").otherwise("pass"),
        text(c("bad"), " of ", c("borrowers"), " borrowers carry conflicting demographics"),
        {"borrowers": c("borrowers"), "borrowers_with_several_loans": c("several"), "count": c("bad")})


def severe_defect(results_findings: str = "findings") -> Column:
    return F.exists(results_findings, lambda f: f["root_cause"] & (f["axis"] == "integrity")
                    & f["severity"].isin("high", "critical"))


def circuit_breaker_check(results: DataFrame, policy: Policy) -> DataFrame:
    limit = policy.tape.circuit_breaker_share
    stats = results.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("data_integrity") == "defect") & severe_defect()).alias("severe"))
    c = F.col
    share = F.try_divide("severe", "n")
    return _check(
        stats, "I3", "Few loans carry a severe integrity defect", "critical",
        F.when(c("n") == 0, "not_evaluable").when(share <= limit, "pass").otherwise("fail"),
        text(c("severe"), " of ", c("n"), " loans carry a severe integrity defect, limit ", limit),
        {"severe_defect_share": F.round(share, 3), "severe_defects": c("severe"), "limit": F.lit(limit)})


def benford_segments(loans: DataFrame, amounts: DataFrame, policy: Policy) -> DataFrame:
    """Digit profile per status, product and vintage through one grouping-sets style expansion; only
    segments with enough amounts are reported."""
    c = F.col
    keyed = loans.select(
        *KEY,
        F.coalesce(public_category(c("loan_status"), LOAN_STATUSES), F.lit("None")).alias("status"),
        F.coalesce(public_category(c("loan_type"), LOAN_TYPES), F.lit("None")).alias("loan_type"),
        F.coalesce(F.year("disbursal_date").cast("string"), F.lit("None")).alias("vintage"),
    )
    label = F.explode(F.array(*[
        F.concat(F.lit(f"{n}="), c(n)).alias(n) for n in ("status", "loan_type", "vintage")
    ])).alias("segment")
    members = keyed.select(label).groupBy("segment").agg(F.count(F.lit(1)).alias("loans"))
    tagged = amounts.join(keyed, KEY).select("cents", label)
    profile = digits.digit_profile(tagged, "cents", ["segment"])
    return profile.filter(c("distinct_amounts") >= policy.tape.benford_min_sample).join(members, "segment")


def heaviest_digit(amounts: DataFrame) -> DataFrame:
    """One row: the first digit that carries most value and the loan that carries most of it. Ties go to
    the lower digit and the earlier loan."""
    c = F.col
    per_loan = amounts.filter("cents >= 100").groupBy(
        *KEY, "loan_id", digits.first_digit(c("cents")).alias("digit")).agg(F.sum(c("cents").cast(digits.WIDE)).alias("cents"))
    per_digit = per_loan.groupBy("digit").agg(
        F.sum("cents").alias("digit_cents"),
        F.max(F.struct(c("cents"), (-c("source_row_index")).alias("pos"), c("loan_id"))).alias("top"))
    return per_digit.agg(
        F.max(F.struct(c("digit_cents"), (-c("digit")).alias("neg"), c("top.loan_id").alias("loan"))).alias("m"),
        F.sum("digit_cents").alias("all"),
    ).select((-c("m.neg")).alias("heaviest_digit"), F.round(c("m.digit_cents").cast("double") / c("all").cast("double"), 3).alias("share"),
             c("m.loan").alias("top_loan"))


def benford_check(amounts: DataFrame, policy: Policy) -> DataFrame:
    t, c = policy.tape, F.col
    big = amounts.filter("cents >= 100")
    profile = digits.digit_profile(amounts, "cents", [])
    contributing = big.groupBy(*KEY).agg(F.lit(1)).agg(F.count(F.lit(1)).alias("loans"))
    # every side is one row; a constant equi-key keeps this an ordinary broadcast of single rows
    one = lambda df: df.withColumn("_one", F.lit(1))
    stats = one(contributing).join(one(profile), "_one", "left").join(
        F.broadcast(one(heaviest_digit(amounts))), "_one", "left")
    n = F.coalesce(c("distinct_amounts"), F.lit(0))
    status = (
        F.when((n < t.benford_min_sample) | (c("loans") < t.benford_min_loans)
               | (c("orders_of_magnitude") < 2), "not_evaluable")
        .when(c("first_digit_mad") <= t.benford_max_mad, "pass").otherwise("fail")
    )
    return _check(
        stats, "I4", "Distinct paid amounts follow the first-digit law", "info", status,
        text(n, " distinct paid amounts of ", c("loans"), " loans, first-digit deviation ",
             c("first_digit_mad"), " (", c("first_digit_band"), ")"),
        {"sample": n, "loans": c("loans"), "first_digit_mad": c("first_digit_mad"),
         "first_digit_band": c("first_digit_band"), "first_two_digits_mad": c("first_two_digits_mad"),
         "first_two_digits_band": c("first_two_digits_band"),
         "orders_of_magnitude": F.round("orders_of_magnitude", 2),
         "heaviest_digit": c("heaviest_digit"), "heaviest_share": c("share"), "top_loan": c("top_loan")})


def shared_amounts(amounts: DataFrame, policy: Policy) -> DataFrame:
    """Non-round paid amounts above the floor that several loans share."""
    floor = round(policy.tape.duplicate_amount_floor_eur * 100)
    odd = amounts.filter((F.col("cents") >= floor) & (F.col("cents") % 100 != 0))
    return shared_rows(odd, ["cents"], "loan_id")


def top_shared_amounts(amounts: DataFrame, policy: Policy, k: int = 10) -> DataFrame:
    return shared_amounts(amounts, policy).orderBy(F.desc("owners"), "cents").limit(k)


def shared_rows_check(rows: DataFrame, amounts: DataFrame, policy: Policy) -> DataFrame:
    c = F.col
    shared = shared_rows(rows, ROW_IDENTITY, "loan_id").agg(
        F.count(F.lit(1)).alias("shared"), F.min("first_owner").alias("example"))
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"))
    odd = shared_amounts(amounts, policy).agg(F.count(F.lit(1)).alias("amounts"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    stats = one(total).join(one(shared), "_one").join(one(odd), "_one")
    return _check(
        stats, "I5", "No paid record occurs under two loans", "high",
        F.when(c("rows") == 0, "not_evaluable").when(c("shared") > 0, "fail").otherwise("pass"),
        text(c("shared"), " paid records occur under more than one loan (", c("rows"), " compared)"),
        {"paid_rows": c("rows"), "shared_rows": c("shared"), "shared_amounts_over_floor": c("amounts"),
         "amount_floor_eur": F.lit(policy.tape.duplicate_amount_floor_eur), "example_loan": c("example")})


def round_number_check(loans: DataFrame, rounds: DataFrame, policy: Policy) -> DataFrame:
    t, c = policy.tape, F.col
    total = lambda n: F.coalesce(F.sum(n), F.lit(0)).alias(n)
    amounts = rounds.agg(total("computed_amounts"), total("round_amounts"))
    late = loans.filter("days_late <> 0").agg(
        F.count(F.lit(1)).alias("late"), F.count_if(c("days_late") % 30 == 0).alias("late30"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    stats = one(amounts).join(one(late), "_one")
    share, late_share = F.try_divide("round_amounts", "computed_amounts"), F.try_divide("late30", "late")
    return _check(
        stats, "I6", "Cents of computed amounts look random", "info",
        F.when(c("computed_amounts") < t.round_min_sample, "not_evaluable")
        .when(share <= t.round_share_max, "pass").otherwise("fail"),
        text(F.round(share, 3), " of ", c("computed_amounts"), " computed amounts have no cents; ",
             F.when(c("late") >= t.round_min_days_late, F.round(late_share, 3)).otherwise(F.lit(None)),
             " of ", c("late"), " days-late values are multiples of 30"),
        {"computed_amounts": c("computed_amounts"), "round_share": F.round(share, 3),
         "max_round_share": F.lit(t.round_share_max), "days_late_values": c("late"),
         "days_late_multiple_of_30_share": F.round(late_share, 3)})


def fact_checks(facts: TapeFacts, results: DataFrame, policy: Policy) -> DataFrame:
    """Six rows, from the facts of a whole tape however many batches they come from."""
    out = duplicate_ids_check(facts.loans)
    for part in (
        demographics_check(facts.loans), circuit_breaker_check(results, policy), benford_check(facts.amounts, policy),
        shared_rows_check(facts.paid, facts.amounts, policy), round_number_check(facts.loans, facts.rounds, policy),
    ):
        out = out.unionByName(part)
    return out


def tape_checks(loans: DataFrame, payments: DataFrame, results: DataFrame, policy: Policy) -> DataFrame:
    """Six rows. ``payments`` and ``results`` should be staged."""
    return fact_checks(tape_facts(loans, payments, policy), results, policy)


def amount_profile(facts: TapeFacts, policy: Policy) -> DataFrame:
    """Long (metric, key, count, share): first digits by count and by value, first-digit deviation of each segment with
    enough amounts, and the non-round amounts that most loans share (a top-k report)."""
    c = F.col
    line = lambda df, metric, key, count, share: df.select(
        F.lit(metric).alias("metric"), key.cast("string").alias("key"), count.cast("bigint").alias("count"),
        share.cast("double").alias("share"))
    each = digits.digit_shares(facts.amounts, "cents")
    segments = benford_segments(facts.loans, facts.amounts, policy)
    none = F.lit(None)
    return (
        line(each, "first_digit", c("digit"), c("n"), c("observed_share"))
        .unionByName(line(each, "first_digit_value", c("digit"), c("n"), c("summation_share")))
        .unionByName(line(segments, "segment", c("segment"), c("distinct_amounts"), c("first_digit_mad")))
        .unionByName(line(top_shared_amounts(facts.amounts, policy), "shared_amount", c("cents"), c("owners"), none))
    )


def tape_findings(checks: DataFrame) -> DataFrame:
    return checks.filter("status = 'fail'").select("rule_id", "group", "severity", "message", "evidence")


def flagged_profile(results: DataFrame) -> DataFrame:
    """Long (metric, key, n) profile of the flagged loans. One pass: every loan contributes its own
    (metric, key) pairs and they are counted."""
    c = F.col
    flagged = c("verdict") == "flagged"
    pair = lambda m, k: F.struct(F.lit(m).alias("metric"), k.alias("key"))
    status = F.coalesce(public_category(c("loan_status"), LOAN_STATUSES), F.lit("unknown"))
    axes = F.when(c("root_axes") == "", "none").otherwise(c("root_axes"))
    roots = F.transform(
        F.filter("findings", lambda f: f["root_cause"] & (f["severity"] != "info")),
        lambda f: pair("by_root_rule", f["rule_id"]))
    pairs = F.when(flagged, F.concat(
        F.array(pair("flagged", F.lit("all")), pair("by_loan_status", status), pair("by_root_axis", axes)),
        roots,
    )).when(c("reported_count") > 0, F.array(pair("normal_with_minor_observations", F.lit("all"))))
    return results.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.key").agg(
        F.count(F.lit(1)).alias("n"))
