"""ANSI SQL twins of the registered queries, written for a single-node engine over the same tables.

They are deliberately plain: per-loan windows, theta joins, no skew handling. Nothing in the library uses them.
"""

from __future__ import annotations

from tape_audit.plans.catalog import RULES as CATALOGUE

AS_OF = "DATE '1997-03-31'"

LOANS = """
loans AS (
  SELECT l.*, coalesce(c.n_records, 0) AS n_records, FALSE AS bad_diary, FALSE AS truncated, 0 AS n_fields_bad,
    0.0::DOUBLE AS sum_rep_int, 0.0::DOUBLE AS sum_out_int, 0.0::DOUBLE AS sum_delay_int FROM (
    SELECT o_orderkey AS id, o_custkey AS cust, o_totalprice AS amount,
      CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS borrower_id,
      CAST(DATE '1993-01-05' + CAST(o_orderkey * 7 % 1500 AS INTEGER) AS DATE) AS disbursal,
      CAST(1 + o_custkey % 30 AS DOUBLE) AS rate, 1 + o_orderkey % 36 AS term,
      CASE o_orderstatus WHEN 'F' THEN 'repaid' WHEN 'O' THEN 'granted' ELSE 'terminated' END AS status,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'deferred annuity' ELSE 'instalment' END AS product,
      o_orderkey % 45 AS days_late, 1940 + o_custkey % 70 AS birth_year,
      CASE WHEN o_custkey % 7 = 0 THEN 'business' ELSE 'individual' END AS borrower_type,
      CASE WHEN o_orderkey % 401 = 0 THEN 'E' ELSE 'B' END AS score,
      CASE WHEN o_orderkey % 97 = 0 THEN 'loan_purpose.3' ELSE 'refinancing' END AS purpose,
      CASE WHEN o_orderkey % 11 = 0 THEN 'unemployed' ELSE 'employed' END AS employment,
      CASE WHEN o_orderkey % 503 = 0 THEN -1.0 ELSE 0.0 END AS arrears,
      floor(o_totalprice * 2) / 100 AS monthly_payment,
      (o_orderkey % 9) * 1000.0 AS family_income,
      CASE WHEN o_orderkey % 4 <> 0 THEN 2500.0 END AS borrower_income,
      o_custkey % 5 - CASE WHEN o_orderkey % 701 = 0 THEN 5 ELSE 0 END AS children,
      CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 17 = 0 THEN 100.0 ELSE 0.0 END
           ELSE round(o_totalprice * CAST(0.4 AS DOUBLE), 2) END AS outstanding
    FROM orders) l
  LEFT JOIN (SELECT l_orderkey, sum(CASE WHEN l_partkey % 50 = 0 THEN 2 ELSE 1 END) AS n_records
             FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = l.id
),
lo AS (
  SELECT *, amount - outstanding - CASE WHEN id % 13 = 0 THEN CAST(5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS repaid_principal,
    CAST(disbursal + to_months(CAST(term + CASE WHEN id % 19 = 0 THEN 6 ELSE 0 END AS INTEGER)) AS DATE)
      AS expected,
    CASE WHEN status = 'repaid' AND id % 10 <> 0
         THEN CAST(disbursal + to_months(CAST(term AS INTEGER)) AS DATE) END AS repayment
  FROM loans
)"""

RECORDS = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus,
    count(*) * max(CASE WHEN l_partkey % 50 = 0 THEN 2 ELSE 1 END) AS n
  FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6, 7
),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY l_orderkey, l_partkey % 256 ORDER BY l_linenumber, l_partkey,
      l_suppkey, l_extendedprice, l_returnflag, l_linestatus) - 1) * 256 + l_partkey % 256 AS position
  FROM lines
),
apart AS (
  SELECT *, 0 AS later, 1 AS copies FROM placed
  UNION ALL SELECT *, 1, n - 1 FROM placed WHERE n > 1
),
shaped AS (
  SELECT l_orderkey AS id, position * 2 + later AS seq, copies, l_partkey AS part, l_suppkey AS supp,
    l_partkey % 20 AS kind, l_linestatus = 'F' AS is_paid, l_returnflag AS flag,
    CAST(DATE '1993-01-05' + CAST(l_orderkey * 7 % 1500 AS INTEGER) AS DATE) AS disbursal,
    l_orderkey + CASE WHEN l_partkey % 701 = 0 THEN 1 ELSE 0 END AS record_id,
    CASE WHEN l_partkey % 997 = 0 THEN -l_extendedprice WHEN l_partkey % 499 = 0 THEN 0.0
         ELSE l_extendedprice END AS amount,
    l_linenumber AS line
  FROM apart
),
dated AS (
  SELECT *,
    CASE WHEN part % 613 = 0 THEN 'unknown' WHEN kind = 0 THEN 'full early repayment'
      WHEN kind = 1 THEN 'partial early repayment' WHEN kind = 2 THEN 'repayment after agreement termination'
      WHEN kind = 3 THEN 'overdue interest' WHEN kind <= 5 THEN 'contract fee repayment'
      WHEN kind <= 12 THEN 'principal' ELSE 'interest' END AS type,
    CASE WHEN part % 641 <> 0 THEN CAST(disbursal + to_months(CAST(line AS INTEGER)) AS DATE) END AS due,
    CASE WHEN id % 3 = 0 THEN greatest((part * 31 + supp) % 121 - 115, 0)
         ELSE (part * 31 + supp) % 121 - 5 END AS lag_days,
    CAST(disbursal + to_months(CAST(1 + id % 4 AS INTEGER)) AS DATE) AS settle
  FROM shaped
),
paid_on AS (
  SELECT *,
    CASE WHEN NOT is_paid THEN CASE WHEN supp % 43 = 0 THEN CAST(due + 3 AS DATE) END
      WHEN part % 653 = 0 THEN NULL
      WHEN kind <= 1 OR part % 11 = 0 THEN settle ELSE CAST(due + CAST(lag_days AS INTEGER) AS DATE) END AS actual,
    CASE WHEN is_paid THEN CASE WHEN supp % 37 = 0 THEN 10.0 ELSE 0.0 END
      WHEN supp % 41 = 0 THEN amount + 1.0 WHEN kind <= 1 AND supp % 5 = 0 THEN 0.0
      WHEN flag = 'R' THEN floor(amount * 50) / 100 ELSE amount END AS pending
  FROM dated
),
stated AS (
  SELECT *,
    CASE WHEN is_paid THEN CASE WHEN coalesce(datediff('day', due, actual) <= 5, TRUE) OR supp % 29 = 0
           THEN 'paid on time' ELSE 'paid with delay' END
      WHEN supp % 9 = 0 THEN 'payment in grace period'
      WHEN due < {AS_OF} THEN 'pending late' ELSE 'pending' END AS state,
    (type = 'unknown') OR due IS NULL AS has_issue,
    CASE WHEN due IS NOT NULL THEN '%d/%m/%Y' END AS due_fmt,
    CASE WHEN actual IS NOT NULL THEN CASE WHEN part % 703 = 0 THEN 'iso' ELSE '%d/%m/%Y' END END AS actual_fmt,
    type IN ('principal', 'contract fee repayment') AS t_sched,
    type IN ('interest', 'overdue interest') AS t_int,
    type IN ('full early repayment', 'partial early repayment') AS t_early
  FROM paid_on
)"""

PAYMENTS = f"""
closed AS (
  SELECT *, (t_sched OR t_int) AND coalesce(actual < due, FALSE) AND max(CASE WHEN t_early AND is_paid
      AND actual IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY id, actual) = 1 AS is_closure
  FROM stated
),
marked AS (
  SELECT *,
    t_early AND (max(CASE WHEN is_closure AND t_sched THEN 1 ELSE 0 END) OVER (PARTITION BY id, actual) = 1
      OR (NOT is_paid AND coalesce(pending, 0) = 0)) AS is_marker,
    (t_sched OR type = 'interest') AND row_number() OVER (PARTITION BY id, due, actual, type, state, amount,
      pending ORDER BY seq) > 1 AS is_dup,
    max(CASE WHEN t_sched AND is_paid AND NOT is_closure THEN actual END) OVER (PARTITION BY id) AS last_regular
  FROM closed
),
tagged AS (
  SELECT *, type = 'full early repayment' AND is_paid AND NOT is_marker
    AND coalesce(last_regular > actual, FALSE) AS is_aborted
  FROM marked
),
cash AS (
  SELECT *,
    CASE WHEN amount IS NULL OR is_marker OR is_aborted OR is_dup THEN 0.0
      WHEN pending BETWEEN 0 AND amount THEN amount - pending WHEN is_paid THEN amount ELSE 0.0 END AS paid_eur,
    CASE WHEN amount IS NULL OR is_marker OR is_aborted OR is_dup THEN 0.0
      WHEN pending BETWEEN 0 AND amount THEN pending WHEN is_paid THEN 0.0 ELSE amount END AS open_eur,
    NOT is_closure AND NOT is_dup AND (t_sched OR t_int) AS regular,
    t_sched AND NOT is_dup AS sched_row, t_int AND NOT is_dup AS int_row,
    (t_early OR type = 'repayment after agreement termination') AND NOT is_marker AND NOT is_aborted AS settlement,
    datediff('day', due, actual) AS delay, datediff('day', due, {AS_OF}) AS dpd
  FROM tagged
),
pay AS (
  SELECT *, late_row AND paid_eur > 0 AND delay IS NOT NULL AS paid_delay,
    late_row AND open_eur > 0 AND state <> 'unknown' AS unpaid_row,
    CAST(round(paid_eur * 1000000) AS BIGINT) AS paid_m, CAST(round(open_eur * 1000000) AS BIGINT) AS open_m,
    CAST(round(amount * 1000000) AS BIGINT) AS amount_m
  FROM (SELECT *, regular AND type IN ('principal', 'interest', 'contract fee repayment') AND due IS NOT NULL
        AS late_row FROM cash)
)"""


def _n(flag: str) -> str:
    return f"coalesce(sum(copies) FILTER (WHERE {flag}), 0)"


def _m(flag: str, value: str) -> str:
    return f"CAST(coalesce(sum({value} * copies) FILTER (WHERE {flag}), 0) AS BIGINT)"


_OPEN_STATES = "state IN ('pending', 'pending late', 'payment in grace period')"
_C6 = "amount IS NOT NULL AND pending IS NOT NULL AND NOT is_marker"
_MEASURES = {
    "n_issue": _n("has_issue"),
    "n_insane": _n("NOT coalesce(NOT has_issue AND due IS NOT NULL AND amount IS NOT NULL AND pending IS NOT NULL "
                   "AND pending BETWEEN 0 AND amount AND (NOT is_paid OR actual IS NOT NULL), FALSE)"),
    "n_foreign": _n("record_id <> id"),
    "fmt_lo": "min(least(due_fmt, actual_fmt))", "fmt_hi": "max(greatest(due_fmt, actual_fmt))",
    "n_dup": _n("is_dup"), "n_closure": _n("is_closure"),
    "m_sched": _m("sched_row", "amount_m"), "m_settle": _m("settlement", "amount_m"),
    "m_paid": _m("sched_row OR settlement", "paid_m"),
    "m_int_paid": _m("type = 'interest' AND int_row", "paid_m"),
    "m_int_open": _m("type = 'interest' AND int_row AND NOT is_closure", "open_m"),
    "m_over_paid": _m("type = 'overdue interest' AND int_row", "paid_m"),
    "m_int_all": _m("type = 'interest' AND int_row AND NOT is_closure", "amount_m"),
    "m_int_all_paid": _m("type = 'interest' AND int_row AND NOT is_closure", "paid_m"),
    "m_any_int_paid": _m("int_row AND NOT is_closure", "paid_m"),
    "first_int_due": "min(due) FILTER (WHERE type = 'interest' AND int_row AND NOT is_closure)",
    "n_cash": _n("paid_eur > 0"), "n_cash_undated": _n("paid_eur > 0 AND actual IS NULL"),
    "first_cash": "min(actual) FILTER (WHERE paid_eur > 0)", "last_cash": "max(actual) FILTER (WHERE paid_eur > 0)",
    "n_prin_undated": _n("(sched_row OR settlement) AND paid_eur > 0 AND actual IS NULL"),
    "n_neg": _n("amount < 0 OR pending < 0"), "n_above": _n("pending > amount + 0.005"),
    "n_paid_pending": _n(f"{_C6} AND is_paid AND pending > 0.005"),
    "n_open_above": _n(f"{_C6} AND {_OPEN_STATES} AND pending > amount + 0.005"),
    "n_open_part": _n(f"{_C6} AND {_OPEN_STATES} AND pending < amount - 0.005"),
    "n_zero": _n("is_paid AND abs(amount) < 0.005 AND NOT t_early"),
    "first_due": "min(due)", "last_due": "max(due)", "first_actual": "min(actual)", "last_actual": "max(actual)",
    "last_paid": "max(actual) FILTER (WHERE is_paid)",
    "n_future": _n(f"is_paid AND actual > {AS_OF}"),
    "n_grace": _n("state = 'payment in grace period' AND dpd > 15"),
    "n_early": _n("late_row AND is_paid AND delay < -3"),
    "n_label": _n("late_row AND state = 'paid on time' AND delay > 5"),
    "n_open": _n("regular AND open_eur > 0"), "m_open": _m("regular AND open_eur > 0", "open_m"),
    "due_open": "count(DISTINCT due) FILTER (WHERE regular AND open_eur > 0)",
    "n_term": _n("type = 'repayment after agreement termination'"),
    "n_claim": _n("type = 'repayment after agreement termination' AND open_eur > 0"),
    "m_claim": _m("type = 'repayment after agreement termination' AND open_eur > 0", "open_m"),
    "claims": "list(dpd) FILTER (WHERE type = 'repayment after agreement termination' AND open_eur > 0 "
              "AND dpd IS NOT NULL)",
    "n_paid_undated": _n("is_paid AND actual IS NULL"),
    "n_unpaid_dated": _n("regular AND NOT is_paid AND paid_eur <= 0 AND actual IS NOT NULL"),
    "closing": "max(actual) FILTER (WHERE type = 'full early repayment' AND is_paid AND NOT is_aborted)",
    "n_late90": _n("paid_delay AND delay >= 90"),
    "due_late90": "count(DISTINCT due) FILTER (WHERE paid_delay AND delay >= 90)",
    "worst_delay": "max(delay) FILTER (WHERE paid_delay)",
    "n_late_band": _n("paid_delay AND delay >= 30 AND delay < 90"),
    "worst_band_paid": "max(delay) FILTER (WHERE paid_delay AND delay >= 30 AND delay < 90)",
    "n_unpaid": _n("unpaid_row"),
    "n_overdue": _n("unpaid_row AND dpd > 0"), "worst_dpd": "max(dpd) FILTER (WHERE unpaid_row AND dpd > 0)",
    "n_over90": _n("unpaid_row AND dpd >= 90"), "m_over90": _m("unpaid_row AND dpd >= 90", "open_m"),
    "due_over90": "count(DISTINCT due) FILTER (WHERE unpaid_row AND dpd >= 90)",
    "n_over_band": _n("unpaid_row AND dpd >= 30 AND dpd < 90"),
    "worst_band_open": "max(dpd) FILTER (WHERE unpaid_row AND dpd >= 30 AND dpd < 90)",
    "n_regular": _n("regular"), "n_regular_paid": _n("regular AND is_paid"),
    "n_early_rows": _n("settlement AND t_early"),
    "n_term_cash": _n("settlement AND type = 'repayment after agreement termination'"),
    "n_state_over": _n("regular AND NOT is_paid AND dpd > 0"),
    "m_state_over": _m("regular AND NOT is_paid AND dpd > 0", "open_m"),
    "max_state_dpd": "max(dpd) FILTER (WHERE regular AND NOT is_paid AND dpd > 0)",
    "next_due": f"min(due) FILTER (WHERE regular AND NOT is_paid AND due >= {AS_OF})",
    "n_delays": _n("paid_delay"), "n_late": _n("paid_delay AND delay > 5"),
    "m_prin_type": _m("type = 'principal' AND NOT is_dup", "paid_m"),
    "m_fee_type": _m("type = 'contract fee repayment' AND NOT is_dup", "paid_m"),
    "m_closure": _m("sched_row AND is_closure", "paid_m"), "m_settle_paid": _m("settlement", "paid_m"),
    "periods": "count(DISTINCT due) FILTER (WHERE regular)",
    "periods_int": "count(DISTINCT due) FILTER (WHERE regular AND type = 'interest')",
    "periods_prin": "count(DISTINCT due) FILTER (WHERE regular AND type = 'principal')",
    "int_dues": "list(DISTINCT due) FILTER (WHERE regular AND type = 'interest' AND due IS NOT NULL)",
    "prin_dues": "list(DISTINCT due) FILTER (WHERE regular AND type = 'principal' AND due IS NOT NULL)",
}
_ZEROS = [k for k in _MEASURES if k[:2] in ("n_", "m_") or k.startswith(("due_", "periods"))]

FEATURES = "agg AS (SELECT id, " + ", ".join(f"{v} AS {k}" for k, v in _MEASURES.items()) + """
  FROM pay GROUP BY id),
princ AS (
  SELECT id, count(*) AS dates, count(*) FILTER (WHERE gap > 45) AS gaps, count(*) FILTER (WHERE gap < 20) AS doubles
  FROM (SELECT id, datediff('day', lag(due) OVER (PARTITION BY id ORDER BY due), due) AS gap
        FROM (SELECT DISTINCT id, due FROM pay WHERE regular AND type = 'principal' AND due IS NOT NULL))
  GROUP BY id),
slots AS (
  SELECT id, count(*) AS conflicts, bool_or(any_open) AS conflict_open
  FROM (SELECT id, type, due, bool_or(NOT is_paid) AS any_open FROM pay
        WHERE regular AND type IN ('principal', 'interest', 'contract fee repayment') AND due IS NOT NULL
        GROUP BY id, type, due HAVING sum(copies) > 1)
  GROUP BY id),
epis AS (
  SELECT id, count(*) AS episodes, max(d) FILTER (WHERE r > 3) AS base_worst,
    count(*) FILTER (WHERE r <= 3 AND d > 5) AS exceeding
  FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY due DESC) AS r
        FROM (SELECT id, due, max(delay) AS d FROM pay WHERE paid_delay GROUP BY id, due))
  GROUP BY id),
feat AS (
  SELECT lo.*, """ + ", ".join(
    f"coalesce(agg.{k}, 0) AS {k}" if k in _ZEROS else f"agg.{k}" for k in _MEASURES) + """,
    coalesce(princ.dates, 0) AS dates, coalesce(gaps, 0) AS gaps, coalesce(doubles, 0) AS doubles,
    coalesce(conflicts, 0) AS conflicts, conflict_open,
    coalesce(episodes, 0) AS episodes, base_worst, coalesce(exceeding, 0) AS exceeding
  FROM lo LEFT JOIN agg USING (id) LEFT JOIN princ USING (id) LEFT JOIN slots USING (id) LEFT JOIN epis USING (id)
)"""

_EMPTY = "(bad_diary OR n_records = 0)"
_WHOLE = f"({_EMPTY} OR truncated)"


def _case(skip: str | None, fail: str, severity: str) -> str:
    guard = f"WHEN {skip} THEN 'not_evaluable' " if skip else ""
    sev = severity if severity.startswith("CASE") else f"'{severity}'"
    return f"CASE {guard}WHEN coalesce({fail}, FALSE) THEN 'fail:' || {sev} ELSE 'pass' END"


_B1 = "((m_sched + m_settle) / 1000000.0::DOUBLE - amount)"
_SPLIT = "(repaid_principal + outstanding)"
_UNRES = "((m_open + m_claim) / 1000000.0::DOUBLE)"
_MONTHS = "((year(expected) - year(disbursal)) * 12 + month(expected) - month(disbursal))"
_NEG_SUMMARY = "least(amount, outstanding, repaid_principal, monthly_payment, arrears, days_late) < 0"

RULES: dict[str, dict[str, str]] = {
    "readability": {
        "A2": _case(None, "borrower_id IS NULL", "high"), "A3": _case(None, "n_fields_bad > 0", "high"), "A4": "'pass'",
        "A5": _case(_EMPTY, "fmt_lo <> fmt_hi", "medium"),
        "A6": _case(None, "score NOT IN ('A', 'B', 'C', 'D') OR purpose LIKE 'loan_purpose.%'",
                    "CASE WHEN score = 'B' THEN 'low' ELSE 'medium' END"),
        "A7": _case(None, _EMPTY, "high"), "A8": _case("bad_diary", "truncated", "info"),
        "A9": _case(_EMPTY, "n_issue > 0", "medium"), "A10": _case(_EMPTY, "n_foreign > 0", "high"),
    },
    "identity": {
        "B1": _case(f"{_WHOLE} OR amount IS NULL", f"abs({_B1}) > 0.5",
                    f"CASE WHEN abs({_B1}) > CAST(0.1 AS DOUBLE) * amount THEN 'high' WHEN abs({_SPLIT} - "
                    f"(m_sched + m_settle) / 1000000.0::DOUBLE) <= 0.5 THEN 'low' ELSE 'medium' END"),
        "B2": _case("amount IS NULL", "abs(outstanding + repaid_principal - amount) > 0.5", "critical"),
        "B3": _case(_WHOLE, "abs(m_paid / 1000000.0::DOUBLE - repaid_principal) > 0.5", "high"),
        "B4": _case(_WHOLE, "abs(m_int_paid / 1000000.0::DOUBLE - sum_rep_int) > 1", "high"),
        "B5": _case(_WHOLE, "abs(m_int_open / 1000000.0::DOUBLE - sum_out_int) > 1", "high"),
        "B6": _case(_WHOLE, "abs(m_over_paid / 1000000.0::DOUBLE - sum_delay_int) > 1", "medium"),
        "B7": _case(f"{_EMPTY} OR (truncated AND n_overdue = 0)", "NOT (abs(coalesce(worst_dpd, 0) - days_late) <= 5 OR coalesce(len(list_filter(claims, "
                            "lambda v: abs(v - days_late) <= 5)) > 0, FALSE))", "medium"),
        "B11": _case(None, f"abs({_MONTHS} - term) > 2", "medium"),
    },
    "arithmetic": {
        "C4": _case(None, f"{_NEG_SUMMARY} OR n_neg > 0", "critical"),
        "C5": _case(_EMPTY, "n_above > 0", "high"),
        "C6": _case(_EMPTY, "n_paid_pending + n_open_above + n_open_part > 0",
                    "CASE WHEN n_paid_pending + n_open_above > 0 THEN 'high' ELSE 'low' END"),
        "C9": _case(_EMPTY, "n_zero + n_dup > 0", "medium"),
        "C10": _case(_EMPTY, "conflicts > 0", "CASE WHEN conflict_open THEN 'medium' ELSE 'low' END"),
    },
    "temporal": {
        "D1": _case(_EMPTY, "least(first_due, first_actual) < disbursal", "high"),
        "D2": _case(_EMPTY, "n_future > 0", "high"),
        "D3": _case(f"{_EMPTY} OR dates < 3", "gaps + doubles > 0", "medium"),
        "D4": _case(f"{_EMPTY} OR repayment IS NULL OR last_paid IS NULL", "last_paid > repayment + 3", "medium"),
        "D5": _case(None, "repayment < disbursal OR expected < disbursal", "high"),
        "D6": _case(_EMPTY, "n_grace > 0", "medium"),
        "D7": _case(_EMPTY, "n_early > 0", "low"), "D8": _case(_EMPTY, "n_label > 0", "low"),
    },
    "lifecycle": {
        "E1": _case("status <> 'repaid'", "outstanding > 0.5 OR repayment IS NULL OR n_open > 0", "high"),
        "E2": _case("status <> 'granted'",
                    f"repayment IS NOT NULL OR abs(outstanding) <= 0.5 OR (n_open = 0 AND NOT {_WHOLE})", "high"),
        "E3": _case(f"status <> 'terminated' OR {_EMPTY}", f"(n_term = 0 AND n_open = 0) OR {_UNRES} > 0.5", "high"),
        "E4": _case(_EMPTY, "n_paid_undated + n_unpaid_dated > 0", "high"),
        "E5": _case(f"{_EMPTY} OR closing IS NULL", "n_open > 0", "high"),
    },
    "plausibility": {
        "H1": _case("borrower_type = 'business' OR birth_year IS NULL", "year(disbursal) - birth_year NOT BETWEEN 18 AND 100", "medium"),
        "H3": _case("borrower_type = 'business' OR coalesce(nullif(family_income, 0), borrower_income) IS NULL",
                    "monthly_payment / coalesce(nullif(family_income, 0), borrower_income) > 1", "low"),
        "H4": _case(None, "(borrower_type = 'business') = (birth_year IS NOT NULL)", "medium"),
        "H5": _case(None, "rate NOT BETWEEN 0 AND 100 OR term NOT BETWEEN 1 AND 360 OR amount <= 0", "high"),
        "H9": _case(None, "children < 0", "medium"),
        "H10": _case("borrower_income IS NULL", "employment = 'unemployed' AND borrower_income > 0", "low"),
    },
    "lateness": {
        "F1": _case(_EMPTY, "n_late90 > 0", "CASE WHEN status = 'granted' THEN 'critical' ELSE 'high' END"),
        "F2": _case(_EMPTY, "n_over90 > 0", "critical"),
        "F3": _case(_EMPTY, "n_late_band + n_over_band > 0", "CASE WHEN n_over_band > 0 OR "
                    "greatest(worst_band_paid, worst_band_open) >= 60 THEN 'medium' ELSE 'low' END"),
    },
    "behaviour": {
        "G6": _case(f"{_EMPTY} OR n_delays < 6", "round(n_late / n_delays, 3) >= 0.5", "info"),
        "G7": _case(f"{_EMPTY} OR status <> 'granted'", "worst_delay IS NOT NULL AND worst_dpd > greatest(worst_delay, 5)",
                    "low"),
        "G8": _case(f"{_EMPTY} OR episodes < 6 OR base_worst > 5", "exceeding >= 2", "low"),
    },
}

BASE = f"WITH {LOANS.strip()}, {RECORDS.strip()}, {PAYMENTS.strip()}"
FULL = f"{BASE}, {FEATURES}"


def rule_family(family: str) -> str:
    return f"{FULL} SELECT id AS source_row_index, " + ", ".join(
        f"{sql} AS {rule}" for rule, sql in RULES[family].items()) + " FROM feat"


ACCRUAL = """red AS (
  SELECT id, actual AS d, paid_m * copies AS m FROM pay
  WHERE (sched_row OR settlement) AND paid_eur > 0 AND actual IS NOT NULL
  UNION ALL SELECT id, due, open_m * copies FROM pay WHERE sched_row AND due IS NOT NULL),
irow AS (
  SELECT p.id, p.seq, p.due, p.amount, p.copies, lo.rate, lo.disbursal,
    greatest(lo.amount - coalesce((SELECT sum(m) FROM red WHERE red.id = p.id AND red.d < p.due), 0)
      / 1000000.0::DOUBLE, 0) AS balance
  FROM pay p JOIN lo USING (id)
  WHERE p.type = 'interest' AND p.int_row AND NOT p.is_closure AND p.due IS NOT NULL AND p.amount IS NOT NULL),
imiss AS (
  SELECT *, abs(amount - balance * (rate / 100.0::DOUBLE / 12.0::DOUBLE))
      > greatest(CAST(0.5 AS DOUBLE), CAST(0.15 AS DOUBLE) * (balance * (rate / 100.0::DOUBLE / 12.0::DOUBLE))) AS miss
  FROM irow),
iso AS (
  SELECT a.*, row_number() OVER w AS pos, count(*) OVER (PARTITION BY id) AS total,
    lag(due) OVER w AS prev_due, lag(miss) OVER w AS p1, lag(miss, 2) OVER w AS p2,
    lead(miss) OVER w AS n1, lead(miss, 2) OVER w AS n2,
    (SELECT max(b.amount) FROM imiss b WHERE b.id = a.id AND b.due <> a.due) AS others,
    (SELECT count(*) <> count(DISTINCT b.due) FROM imiss b WHERE b.id = a.id) AS crowded
  FROM imiss a WINDOW w AS (PARTITION BY id ORDER BY due)),
iso2 AS (
  SELECT *, datediff('day', CASE WHEN pos = 1 THEN disbursal ELSE prev_due END, due) AS span FROM iso
  WHERE miss AND NOT crowded AND total >= 3
    AND CASE WHEN pos = 1 THEN NOT n1 AND NOT n2 WHEN pos = total THEN NOT p1 AND NOT p2 ELSE NOT p1 AND NOT n1 END),
iso3 AS (
  SELECT id, count(*) AS isolated FROM (
    SELECT *, greatest(balance * rate / 100.0::DOUBLE * greatest(span / 360.0::DOUBLE, 1.0::DOUBLE / 12.0::DOUBLE),
      others) AS upper FROM iso2 WHERE span > 0 AND (pos = 1 OR span BETWEEN 20 AND 45))
  WHERE amount - upper > greatest(1.0::DOUBLE, CAST(0.15 AS DOUBLE) * upper) GROUP BY id),
acc AS (
  SELECT id, sum(copies) AS checked, coalesce(sum(copies) FILTER (WHERE miss), 0) AS missed
  FROM imiss GROUP BY id)"""

C1 = _case(
    f"{_WHOLE} OR amount IS NULL OR product = 'deferred annuity' OR n_prin_undated > 0 OR coalesce(checked, 0) < 2",
    "(missed >= 2 AND missed / checked > 0.5) OR coalesce(isolated, 0) > 0", "medium")

TAIL = """tail AS (
  SELECT id, sum(copies) FILTER (WHERE NOT is_paid AND settled = settled_all) AS streak,
    min(due) FILTER (WHERE NOT is_paid AND settled = settled_all) AS since
  FROM (SELECT *, sum(CASE WHEN is_paid THEN copies ELSE 0 END) OVER (PARTITION BY id ORDER BY due, seq
          ROWS UNBOUNDED PRECEDING) AS settled,
        sum(CASE WHEN is_paid THEN copies ELSE 0 END) OVER (PARTITION BY id) AS settled_all
        FROM pay WHERE regular AND type = 'principal' AND dpd >= 0)
  GROUP BY id)"""
C8 = _case(f"{_EMPTY} OR status <> 'granted'", "streak >= 3", "medium")

RUNS = """runs AS (
  SELECT id, max(run) AS streak FROM (
    SELECT id, island, coalesce(sum(copies) FILTER (WHERE delay > 5), 0) AS run FROM (
      SELECT *, sum(CASE WHEN delay > 5 THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY due, seq
        ROWS UNBOUNDED PRECEDING) AS island FROM pay WHERE paid_delay)
    GROUP BY id, island) GROUP BY id),
halves AS (
  SELECT id, max(n) AS n,
    CAST(sum(delay) FILTER (WHERE r > n // 2) AS DOUBLE) / (max(n) - max(n) // 2) AS m2,
    CAST(sum(delay) FILTER (WHERE r <= n // 2) AS DOUBLE) / nullif(max(n) // 2, 0) AS m1,
    median(delay) AS med, min(dd) AS due_day, min(pd) AS paid_day
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY due, seq) AS r, count(*) OVER (PARTITION BY id) AS n
        FROM pay WHERE paid_delay) x
  JOIN (SELECT id, min(v) AS dd FROM (SELECT id, day(due) AS v, count(*) AS c, max(count(*)) OVER (PARTITION BY id) AS m
        FROM pay WHERE paid_delay GROUP BY id, day(due)) WHERE c = m GROUP BY id) a USING (id)
  JOIN (SELECT id, min(v) AS pd FROM (SELECT id, day(actual) AS v, count(*) AS c, max(count(*)) OVER (PARTITION BY id) AS m
        FROM pay WHERE paid_delay GROUP BY id, day(actual)) WHERE c = m GROUP BY id) b USING (id)
  GROUP BY id)"""


def bisection(flows: str, steps: int = 27, prefix: str = "x") -> str:
    """CTE chain that bisects the net present value of ``flows(id, d, cf)``; result in ``{prefix}rate``."""
    p = prefix
    npv = lambda rate: f"sum(cf / pow(1.0::DOUBLE + {rate}, yrs))"
    ctes = [
        f"{p}flow AS (SELECT id, cf, datediff('day', min(d) OVER (PARTITION BY id), d) / 365.0::DOUBLE AS yrs FROM "
        f"(SELECT id, d, round(sum(cf), 6) AS cf FROM {flows} GROUP BY id, d HAVING round(sum(cf), 6) <> 0))",
        f"{p}0 AS (SELECT id, -0.99::DOUBLE AS lo, 10.0::DOUBLE AS hi, {npv('(-0.99::DOUBLE)')} AS flo, "
        f"NULL::DOUBLE AS root FROM {p}flow GROUP BY id HAVING count(*) >= 2 AND min(cf) < 0 AND max(cf) > 0 "
        f"AND {npv('(-0.99::DOUBLE)')} * {npv('10.0::DOUBLE')} <= 0)",
    ]
    for i in range(steps):
        ctes.append(
            f"{p}{i + 1} AS MATERIALIZED (SELECT s.id, CASE WHEN flo * f < 0 THEN lo ELSE mid END AS lo, "
            f"CASE WHEN flo * f < 0 THEN mid ELSE hi END AS hi, CASE WHEN flo * f < 0 THEN flo ELSE f END AS flo, "
            f"coalesce(root, CASE WHEN abs(f) < 1e-7 OR (hi - lo) / 2 < 1e-7 THEN mid END) AS root FROM "
            f"(SELECT *, (lo + hi) / 2 AS mid FROM {p}{i}) s JOIN (SELECT b.id, "
            f"{npv('(b.lo + b.hi) / 2')} AS f FROM {p}{i} b JOIN {p}flow USING (id) GROUP BY b.id) v USING (id))")
    ctes.append(f"{p}rate AS (SELECT id, root AS rate FROM {p}{steps})")
    return ", ".join(ctes)


RATE_SKIP = (
    f"{_WHOLE} OR amount IS NULL OR n_cash_undated > 0 OR first_cash < disbursal OR last_cash > {AS_OF} OR n_cash < 3 OR "
    "(status = 'granted' AND (product = 'deferred annuity' OR m_int_all <= 0 OR m_int_all_paid / m_int_all < 0.1))")
RATE_FLOWS = f"""cand AS (SELECT * FROM feat WHERE NOT coalesce({RATE_SKIP}, FALSE)),
ends AS (SELECT id, disbursal AS d, -amount AS cf FROM cand
  UNION ALL SELECT id, {AS_OF}, outstanding FROM cand WHERE status = 'granted'),
pflow AS (SELECT * FROM ends UNION ALL SELECT p.id, actual, paid_eur * copies FROM pay p SEMI JOIN cand USING (id)
  WHERE paid_eur > 0),
sflow AS (SELECT * FROM ends UNION ALL SELECT p.id, CASE WHEN regular AND actual > due THEN due ELSE actual END,
  paid_eur * copies FROM pay p SEMI JOIN cand USING (id) WHERE paid_eur > 0)"""
RATES = f"{RATE_FLOWS}, {bisection('pflow', prefix='xp')}, {bisection('sflow', prefix='xs')}"
C2_STATE = """c2 AS (
  SELECT *, realised - rate AS gap, greatest(5.0::DOUBLE, CAST(0.4 AS DOUBLE) * abs(rate)) AS threshold,
    m_any_int_paid / 1000000.0::DOUBLE <= 1 AS nothing_paid,
    coalesce(repayment, last_paid) AS settled,
    (m_sched + m_settle) / 1000000.0::DOUBLE - amount AS pgap
  FROM (SELECT feat.*, xprate.rate * 100 AS realised, xsrate.rate * 100 AS sched_pct FROM feat
        LEFT JOIN xprate USING (id) LEFT JOIN xsrate USING (id))),
c2b AS (
  SELECT *, CASE WHEN gap < 0 AND pgap < -0.5 THEN 'low' WHEN product <> 'deferred annuity' THEN 'high'
      WHEN settled IS NULL THEN 'medium'
      WHEN (expected IS NULL OR settled < expected) AND NOT coalesce(first_int_due < settled, FALSE) THEN 'low'
      WHEN expected IS NULL OR settled < expected THEN 'medium' ELSE 'high' END AS confidence
  FROM c2)"""
C2 = _case(f"coalesce({RATE_SKIP}, FALSE) OR realised IS NULL", "abs(gap) > threshold",
           "CASE WHEN confidence = 'low' THEN 'low' WHEN abs(gap) > 2 * threshold OR nothing_paid THEN 'high' "
           "ELSE 'medium' END")
C2_STANDALONE = (
    "(NOT (gap < 0 AND pgap < -0.5) AND confidence <> 'low' AND (gap > 0 OR nothing_paid OR (sched_pct IS NOT NULL "
    "AND NOT (gap < 0 AND coalesce(abs(sched_pct - rate) <= threshold, FALSE)))))")

META = "meta AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{r.rule_id}', '{r.axis}', '{r.category}', {i}, [{', '.join(repr(x) for x in r.subsumed_by)}]::VARCHAR[])"
    for i, r in enumerate(CATALOGUE)) + ") t(rule_id, axis, category, ordinal, subs))"
_RANK = "list_position(['info', 'low', 'medium', 'high', 'critical'], severity) - 1"
_BROAD = "coalesce(missed >= 2 AND missed / checked > 0.5, FALSE)"
OUTCOMES = f"""wide AS (
  SELECT feat.id, {", ".join(f"{sql} AS {r}" for family in RULES.values() for r, sql in family.items())},
    {C1} AS C1, {C8} AS C8
  FROM feat LEFT JOIN acc USING (id) LEFT JOIN iso3 USING (id) LEFT JOIN tail USING (id)),
ratecol AS (SELECT id, {C2} AS C2 FROM c2b),
outcomes AS (
  SELECT id, rule_id, split_part(o, ':', 1) AS status, nullif(split_part(o, ':', 2), '') AS severity
  FROM (UNPIVOT (SELECT * FROM wide JOIN ratecol USING (id)) ON COLUMNS(* EXCLUDE (id)) INTO NAME rule_id VALUE o)),
alone AS (
  SELECT id, 'C1' AS rule_id FROM acc JOIN iso3 USING (id) WHERE isolated > 0 AND NOT {_BROAD}
  UNION ALL SELECT id, 'C2' FROM c2b WHERE {C2_STANDALONE}),
failed AS (SELECT id, list(rule_id) AS hits FROM outcomes WHERE status = 'fail' GROUP BY id),
found0 AS (
  SELECT o.id, o.rule_id, o.severity, {_RANK} AS rank, m.axis, m.ordinal,
    CASE WHEN a.id IS NULL THEN list_filter(m.subs, lambda s: list_contains(f.hits, s))[1] END AS symptom_of
  FROM outcomes o JOIN meta m USING (rule_id) JOIN failed f ON f.id = o.id
  LEFT JOIN alone a ON a.id = o.id AND a.rule_id = o.rule_id WHERE o.status = 'fail'),
found AS (SELECT *, symptom_of IS NULL AS root FROM found0),
loanfind AS (
  SELECT id, count(*) AS finding_count, count(*) FILTER (WHERE rank > 0) AS reported,
    count(*) FILTER (WHERE rank > 0 AND root) AS roots,
    coalesce(max(rank) FILTER (WHERE rank > 0 AND root), max(rank) FILTER (WHERE rank > 0)) AS top,
    coalesce(max(CASE WHEN axis = 'integrity' THEN rank END) FILTER (WHERE rank > 0 AND root),
      CASE WHEN count(*) FILTER (WHERE rank > 0 AND root) = 0
           THEN max(CASE WHEN axis = 'integrity' THEN rank END) FILTER (WHERE rank > 0) END, 0) AS top_integrity,
    bool_or(rule_id IN ('F1', 'F2')) AS dflt, bool_or(rule_id IN ('F3', 'C8', 'G7')) AS watch,
    string_agg(rule_id, ';' ORDER BY ordinal) AS rule_ids,
    coalesce(bool_or(root AND axis = 'integrity' AND rank >= 3), FALSE) AS severe,
    (list(rule_id ORDER BY rank DESC, CASE axis WHEN 'credit' THEN 0 ELSE 1 END, ordinal)
      FILTER (WHERE rank > 0 AND root))[1] AS lead_rule,
    array_to_string(list_sort(list_distinct(list(axis) FILTER (WHERE rank > 0 AND root))), '+') AS root_axes
  FROM found GROUP BY id),
tally AS (
  SELECT id, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'fail') AS n_failed,
    count(*) FILTER (WHERE status = 'not_evaluable') AS skipped FROM outcomes GROUP BY id),
judged0 AS (
  SELECT f.id, f.status AS loan_status, coalesce(l.top, 0) AS rank, coalesce(top >= 2, FALSE) AS flagged,
    coalesce(top_integrity >= 2, FALSE) AS defect,
    CASE WHEN dflt THEN 'default' WHEN watch THEN 'watch' ELSE 'none' END AS credit_event,
    CASE WHEN bad_diary THEN 'none'
      WHEN truncated OR n_records = 0 OR n_insane > 0 OR borrower_id IS NULL OR coalesce(amount <= 0, TRUE) OR n_fields_bad > 0
        OR f.status NOT IN ('granted', 'repaid', 'terminated')
        OR (n_prin_undated > 0 AND product <> 'deferred annuity' AND NOT {_WHOLE})
        OR (n_cash_undated > 0 AND NOT {_EMPTY})
        OR (f.status = 'repaid' AND repayment IS NULL AND NOT {_EMPTY})
        OR (NOT coalesce({RATE_SKIP}, FALSE) AND realised IS NULL)
      THEN 'partial' ELSE 'full' END AS coverage,
    coalesce(reported, 0) AS reported, coalesce(roots, 0) AS roots, coalesce(finding_count, 0) AS finding_count,
    coalesce(rule_ids, '') AS rule_ids, coalesce(severe, FALSE) AS severe, lead_rule,
    coalesce(root_axes, '') AS root_axes, passed, n_failed, skipped
  FROM c2b f JOIN tally USING (id) LEFT JOIN loanfind l USING (id)),
judged AS (
  SELECT *, CASE WHEN flagged THEN 'flagged' ELSE 'normal' END AS verdict,
    CASE WHEN reported > 0 THEN ['info', 'low', 'medium', 'high', 'critical'][rank + 1] END AS severity,
    CASE WHEN defect THEN 'defect' WHEN coverage = 'full' THEN 'clean' ELSE 'unknown' END AS integrity,
    CASE WHEN flagged THEN 'major' WHEN coverage <> 'full' THEN 'indeterminate' WHEN reported > 0 THEN 'minor'
      ELSE 'clean' END AS tier
  FROM judged0)"""
JUDGED = f"{FULL}, {ACCRUAL}, {TAIL}, {RATES}, {C2_STATE}, {META}, {OUTCOMES}"


# ---- the raw tape out of orders, typed directly -----------------------------------------------------

TAPE_AS_OF = "DATE '2024-01-31'"
TAPE_SOURCE = f"""tape AS (
  SELECT *, total // n AS part, k % 33 = 0 AS early,
    CAST(start + to_months(1) AS DATE) + 5 AS settled
  FROM (
    SELECT o_orderkey AS k, o_custkey AS cust, 3 + o_orderkey % 10 AS n, (1200 + (o_orderkey % 50) * 100) * 100 AS total,
      6 + o_orderkey % 12 AS rate_pct,
      CAST(DATE '2023-01-10' + CAST(o_orderkey % 15 AS INTEGER) + to_months(CAST(o_orderkey % 12 AS INTEGER)) AS DATE) AS start,
      CASE WHEN o_orderkey % 3 = 0 THEN 'repaid' WHEN o_orderkey % 37 = 1 THEN 'terminated' ELSE 'granted' END AS status
    FROM orders)),
steps AS (
  SELECT *, CASE WHEN i = n - 1 THEN total - part * (n - 1) ELSE part END AS principal,
    CASE WHEN k % 19 = 0 THEN ((total - part * i) * rate_pct * 8 + 3000) // 6000
         ELSE ((total - part * i) * rate_pct + 600) // 1200 END AS interest,
    CASE WHEN status = 'repaid' THEN NOT (k % 101 = 0 AND i = n - 1) WHEN status = 'terminated' THEN i < 2
         ELSE due <= {TAPE_AS_OF} AND NOT (k % 23 = 0 AND i >= n - 2) END AS paid,
    CASE WHEN k % 17 = 0 AND i = n - 1 THEN 95 WHEN k % 29 = 0 THEN 20 WHEN k % 43 = 0 AND i = n - 1 THEN 45
         ELSE (k * 7 + i * 3) % 4 END AS lag_days
  FROM (SELECT *, CAST(start + to_months(CAST(i + 1 AS INTEGER)) AS DATE) AS due
        FROM (SELECT *, unnest(range(n)) AS i FROM tape))),
moves AS (
  SELECT *, CASE WHEN paid THEN CASE WHEN early AND i >= 1 THEN CAST(settled AS DATE) ELSE CAST(due + CAST(lag_days AS INTEGER) AS DATE) END END AS actual,
    CASE WHEN paid THEN CASE WHEN (early AND i >= 1) OR lag_days <= 5 THEN 'paid on time' ELSE 'paid with delay' END
         WHEN due < {TAPE_AS_OF} THEN 'pending late' ELSE 'pending' END AS state FROM steps),
recs AS (
  SELECT k AS id, 2 * i AS seq, k + CASE WHEN k % 53 = 0 AND i = 0 THEN 1 ELSE 0 END AS record_id, due, actual,
    'principal' AS type, state, paid AS is_paid, principal / 100.0::DOUBLE AS amount FROM moves
  UNION ALL SELECT k, 2 * i + 1, k, due, actual, 'interest', state, paid, interest / 100.0::DOUBLE FROM moves
  UNION ALL SELECT k, 2 * n, k, settled, settled, 'full early repayment', 'paid on time', TRUE, (total - part) / 100.0::DOUBLE
    FROM tape WHERE early),
kept AS (
  SELECT * FROM (SELECT *, max(seq) OVER (PARTITION BY id) AS last_seq FROM recs)
  WHERE id % 131 <> 0 AND id % 67 <> 0 AND id % 71 <> 0 AND id % 73 <> 0 AND NOT (id % 61 = 0 AND seq = last_seq))"""
TAPE_LOANS = f"""lo AS (
  SELECT t.k AS id, CASE WHEN k % 89 = 0 THEN NULL ELSE total / 100.0::DOUBLE END AS amount, CAST(cust AS VARCHAR) AS borrower_id,
    start AS disbursal, CAST(rate_pct AS DOUBLE) AS rate, n AS term, status, 'instalment' AS product,
    greatest(0, coalesce(datediff('day', first_open, {TAPE_AS_OF}), 0)) AS days_late,
    CASE WHEN cust % 10 <> 0 OR cust % 20 = 0 THEN 1960 + cust % 40 END AS birth_year,
    CASE WHEN cust % 10 = 0 THEN 'business' ELSE 'individual' END AS borrower_type,
    CASE WHEN k % 401 = 0 THEN 'Z' ELSE 'B' END AS score,
    CASE WHEN k % 97 = 0 THEN 'loan_purpose.2' ELSE 'refinancing' END AS purpose, 'employed' AS employment, 0.0 AS arrears,
    (part + first_interest) / 100.0::DOUBLE AS monthly_payment, NULL::DOUBLE AS family_income, 2500.0 AS borrower_income,
    1 AS children, outstanding_c / 100.0::DOUBLE AS outstanding,
    (total - outstanding_c - CASE WHEN k % 83 = 0 THEN 500 ELSE 0 END) / 100.0::DOUBLE AS repaid_principal,
    CAST(start + to_months(CAST(n + CASE WHEN k % 47 = 0 THEN 4 ELSE 0 END AS INTEGER)) AS DATE) AS expected,
    CASE WHEN status = 'repaid' AND k % 59 <> 0 THEN last_actual END AS repayment,
    coalesce(c.n_records, 0) AS n_records, k % 67 = 0 OR k % 71 = 0 AS bad_diary,
    k % 61 = 0 AND k % 67 <> 0 AND k % 71 <> 0 AND k % 73 <> 0 AS truncated,
    CASE WHEN k % 89 = 0 THEN 1 ELSE 0 END AS n_fields_bad,
    paid_int / 100.0::DOUBLE AS sum_rep_int, open_int / 100.0::DOUBLE AS sum_out_int, 0.0::DOUBLE AS sum_delay_int
  FROM (SELECT t.*, CASE WHEN t.status = 'repaid' THEN 0 ELSE open_c END AS outstanding_c, paid_int, open_int, last_actual,
          first_open, first_interest
        FROM tape t JOIN (SELECT k, coalesce(sum(principal) FILTER (WHERE NOT paid), 0) AS open_c,
            coalesce(sum(interest) FILTER (WHERE paid), 0) AS paid_int, coalesce(sum(interest) FILTER (WHERE NOT paid), 0) AS open_int,
            max(actual) AS last_actual, min(due) FILTER (WHERE NOT paid) AS first_open, min(interest) FILTER (WHERE i = 0) AS first_interest
          FROM moves GROUP BY k) m USING (k)) t
  LEFT JOIN (SELECT id, count(*) AS n_records FROM kept GROUP BY id) c ON c.id = t.k WHERE k % 131 <> 0)"""
TAPE_RECORDS = """stated AS (
  SELECT id, seq, 1 AS copies, record_id, due, actual, type, state, is_paid, amount,
    CASE WHEN is_paid THEN 0.0::DOUBLE ELSE amount END AS pending, FALSE AS has_issue, '%d/%m/%Y' AS due_fmt,
    CASE WHEN actual IS NOT NULL THEN '%d/%m/%Y' END AS actual_fmt, type = 'principal' AS t_sched, type = 'interest' AS t_int,
    type = 'full early repayment' AS t_early FROM kept)"""


def on_tape(tail: str) -> str:
    """The same rule twins over the raw tape: another source, another as-of date."""
    chain = f"WITH {TAPE_SOURCE}, {TAPE_LOANS}, {TAPE_RECORDS}, {PAYMENTS.strip()}{tail}"
    return chain.replace(AS_OF, TAPE_AS_OF)


TAPE_JUDGED_TAIL = f", {FEATURES}, {ACCRUAL}, {TAIL}, {RATES}, {C2_STATE}, {META}, {OUTCOMES} "
