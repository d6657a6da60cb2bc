"""Adapters: the driver's tables as ledgers.

``order_ledger`` reads ``orders`` as loans and ``lineitem`` as their payment records (flat, so one order may be
arbitrarily big). ``order_tape`` turns ``orders`` into a raw all-text tape with a nested history per row.
Both are row-local derivations: nothing is joined or gathered to build them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tape_audit.plans.ledger import PAYMENT_BASE, Ledger, dense_position
from tape_audit.session import spread, tuned

AS_OF = date(1997, 3, 31)
TAPE_ID = "driver"
_ANCHOR = date(1993, 1, 5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def disbursal(key: Column) -> Column:
    return F.date_add(F.lit(_ANCHOR), F.pmod(key * 7, F.lit(1500)).cast("int"))


def _months_later(start: Column, months: Column) -> Column:
    return F.add_months(start, months.cast("int"))


def order_loans(orders: DataFrame) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    start = disbursal(k)
    term = 1 + F.pmod(k, F.lit(36))
    status = (
        F.when(F.col("o_orderstatus") == "F", "repaid").when(F.col("o_orderstatus") == "O", "granted")
        .otherwise("terminated")
    )
    expected = _months_later(start, term + F.when(k % 19 == 0, 6).otherwise(0))
    outstanding = F.when(status == "repaid", F.when(k % 17 == 0, 100.0).otherwise(0.0)).otherwise(
        F.round(F.col("o_totalprice") * 0.4, 2))
    repayment = F.when((status == "repaid") & (k % 10 != 0), _months_later(start, term))
    none = lambda t: F.lit(None).cast(t)
    return orders.select(
        F.lit(TAPE_ID).alias("tape_id"), k.alias("source_row_index"), k.alias("loan_id"),
        k.cast("string").alias("loan_id_raw"),
        F.when(k % 211 != 0, cust.cast("string")).alias("borrower_id"),
        F.col("o_totalprice").alias("loan_amount"), start.alias("disbursal_date"),
        F.array(start).alias("disbursal_readings"),
        (1 + cust % 30).cast("double").alias("interest_rate"), term.cast("bigint").alias("loan_term_months"),
        expected.alias("expected_repayment_date"), F.array(expected).alias("expected_readings"),
        (F.floor(F.col("o_totalprice") * 2) / 100).alias("monthly_payment"), (k % 45).alias("days_late"),
        outstanding.alias("outstanding_principal"),
        (F.col("o_totalprice") - outstanding - F.when(k % 13 == 0, 5.0).otherwise(0.0)).alias(
            "repaid_principal"),
        F.lit(0.0).alias("outstanding_interest"), none("double").alias("repaid_interest"),
        repayment.alias("repayment_date"),
        F.when(repayment.isNotNull(), F.array(repayment)).alias("repayment_readings"),
        F.when(k % 503 == 0, -1.0).otherwise(0.0).alias("arrears"), F.lit(0.0).alias("delay_interest"),
        (1940 + cust % 70).alias("birth_year"), (F.pmod(k, F.lit(9)) * 1000.0).alias("family_income"),
        F.when(k % 4 != 0, 2500.0).alias("borrower_income"), F.lit(0.0).alias("family_liabilities"),
        (cust % 5 - F.when(k % 701 == 0, 5).otherwise(0)).cast("double").alias("children"),
        none("double").alias("company_age_years"),
        F.when(F.col("o_orderpriority") == "5-LOW", "deferred annuity").otherwise("instalment").alias(
            "loan_type"),
        F.when(cust % 7 == 0, "business").otherwise("individual").alias("borrower_type"),
        F.when(k % 401 == 0, "E").otherwise("B").alias("credit_score"), status.alias("loan_status"),
        F.when(k % 97 == 0, "loan_purpose.3").otherwise("refinancing").alias("purpose"),
        F.when(k % 11 == 0, "unemployed").otherwise("employed").alias("employment_status"),
        F.array().cast("array<struct<field:string,problem:string>>").alias("parse_issues"),
        F.lit(0).cast("bigint").alias("diary_raw_chars"), F.lit(False).alias("diary_truncated"),
        none("string").alias("diary_error"), F.lit(0).cast("bigint").alias("dropped_tail_chars"),
    )


def order_payments(lineitem: DataFrame) -> DataFrame:
    """Payment records. Identical detail lines are folded into ``copies`` before anything is shuffled by
    loan; the first copy stays alone so that later ones can be tagged as duplicates."""
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
        "l_linestatus",
    )
    folded = lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("n"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus"]
    folded = dense_position(folded, ["l_orderkey"], order, F.pmod("l_partkey", F.lit(256)), "_position")
    n = F.col("n") * F.when(F.col("l_partkey") % 50 == 0, 2).otherwise(1)
    split = folded.select("*", F.explode(F.when(n > 1, F.array(
        F.struct(F.lit(0).alias("later"), F.lit(1).cast("bigint").alias("copies")),
        F.struct(F.lit(1).alias("later"), (n - 1).cast("bigint").alias("copies")),
    )).otherwise(F.array(
        F.struct(F.lit(0).alias("later"), F.lit(1).cast("bigint").alias("copies"))))).alias("c"))
    c = F.col
    part, supp, key = c("l_partkey"), c("l_suppkey"), c("l_orderkey")
    kind = F.pmod(part, F.lit(20))
    type_ = (
        F.when(part % 613 == 0, "unknown")
        .when(kind == 0, "full early repayment").when(kind == 1, "partial early repayment")
        .when(kind == 2, "repayment after agreement termination").when(kind == 3, "overdue interest")
        .when(kind <= 5, "contract fee repayment").when(kind <= 12, "principal").otherwise("interest")
    )
    paid = c("l_linestatus") == "F"
    start = disbursal(key)
    due = F.when(part % 641 != 0, _months_later(start, c("l_linenumber")))
    delay = (F.pmod(part * 31 + supp, F.lit(121)) - F.when(key % 3 == 0, 115).otherwise(5)).cast("int")
    delay = F.when(key % 3 == 0, F.greatest(delay, F.lit(0))).otherwise(delay)
    settle = _months_later(start, 1 + F.pmod(key, F.lit(4)))
    actual = (
        F.when(~paid, F.when(supp % 43 == 0, F.date_add(due, 3)))
        .when(part % 653 == 0, F.lit(None).cast("date"))
        .when((kind <= 1) | (part % 11 == 0), settle).otherwise(F.date_add(due, delay))
    )
    amount = F.when(part % 997 == 0, -c("l_extendedprice")).when(part % 499 == 0, 0.0).otherwise(
        c("l_extendedprice"))
    pending = (
        F.when(paid, F.when(supp % 37 == 0, 10.0).otherwise(0.0))
        .when(supp % 41 == 0, amount + 1.0).when((kind <= 1) & (supp % 5 == 0), 0.0)
        .when(c("l_returnflag") == "R", F.floor(amount * 50) / 100).otherwise(amount)
    )
    state = (
        F.when(paid, F.when(F.coalesce(F.datediff(actual, due) <= 5, F.lit(True)) | (supp % 29 == 0),
                            "paid on time").otherwise("paid with delay"))
        .when(supp % 9 == 0, "payment in grace period")
        .when(due < F.lit(AS_OF), "pending late").otherwise("pending")
    )
    issue = F.array().cast("array<struct<field:string,problem:string>>")
    bad_type = F.array(F.struct(F.lit("Type").alias("field"), F.lit("unknown payment type").alias("problem")))
    no_due = F.array(F.struct(F.lit("Payment date").alias("field"), F.lit("missing").alias("problem")))
    return split.select(
        F.lit(TAPE_ID).alias("tape_id"), key.alias("source_row_index"), key.alias("loan_id"),
        (c("_position") * 2 + c("c.later")).cast("bigint").alias("payment_seq"),
        c("c.copies").alias("copies"),
        (key + F.when(part % 701 == 0, 1).otherwise(0)).cast("string").alias("record_loan_id"),
        due.alias("due_date"), actual.alias("actual_date"),
        F.when(due.isNotNull(), "%d/%m/%Y").alias("due_fmt"),
        F.when(actual.isNotNull(), F.when(part % 703 == 0, "iso").otherwise("%d/%m/%Y")).alias("actual_fmt"),
        type_.alias("type"), state.alias("state"), paid.alias("is_paid"), amount.alias("amount"),
        pending.alias("pending_amount"),
        F.concat(F.when(type_ == "unknown", bad_type).otherwise(issue),
                 F.when(due.isNull(), no_due).otherwise(issue)).alias("issues"),
    ).select(*PAYMENT_BASE)


#: Detail rows up to which an order is gathered in one task, and detail rows that a partition by order should hold.
ORDINARY_ROWS, PART_ROWS = 10_000, 400_000


def order_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """Where every order is small, all of them are dealt by order once and nothing is exchanged by order again; one order
    that is not makes the ledger one of giant loans."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    sizes = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("rows")).first()
    giant, parts = (sizes["top"] or 0) > ORDINARY_ROWS, None
    if not giant:
        parts = spread(spark) * max(1, -(-(sizes["rows"] or 0) // (PART_ROWS * spread(spark))))
        lineitem, orders = lineitem.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    counts = lineitem.groupBy(F.col("l_orderkey").alias("source_row_index")).agg(
        F.sum(F.when(F.col("l_partkey") % 50 == 0, 2).otherwise(1)).alias("n_records"))
    loans = order_loans(orders).join(counts, "source_row_index", "left")
    loans = loans.withColumn("n_records", F.coalesce("n_records", F.lit(0).cast("bigint")))
    return Ledger(loans=loans, payments=order_payments(lineitem), giant_loans=giant, as_of=AS_OF, parts=parts)


# ---- a raw all-text tape out of ``orders`` ---------------------------------------------------------

TAPE_AS_OF = date(2024, 1, 31)


def _cents_text(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("bigint").cast("string"), F.lit("."), F.lpad(F.pmod(c, F.lit(100)).cast("bigint").cast("string"), 2, "0"))


def order_tape(orders: DataFrame) -> DataFrame:
    """One wide text row per order: an instalment loan with its whole payment history packed into one cell,
    in mixed notations, with faults planted by key. Row-local, so it scales with ``orders``."""
    k = F.col("o_orderkey")
    base = orders.select(
        k.alias("k"), F.col("o_custkey").alias("cust"), (3 + k % 10).alias("n"),
        ((1200 + (k % 50) * 100) * 100).alias("total"), (6 + k % 12).alias("rate"),
        F.add_months(F.date_add(F.lit(date(2023, 1, 10)), (k % 15).cast("int")), (k % 12).cast("int")).alias("start"),
        F.when(k % 3 == 0, "repaid").when(k % 37 == 1, "terminated").otherwise("granted").alias("status"),
    )
    c = F.col
    base = base.withColumns({
        "part": F.floor(c("total") / c("n")),
        "settled": F.date_add(F.add_months("start", 1), 5),
        "early": c("k") % 33 == 0,
    })

    def row(i: Column) -> Column:
        i = i.cast("int")
        due = F.add_months(c("start"), i + 1)
        left = c("total") - c("part") * i
        principal = F.when(i == c("n") - 1, c("total") - c("part") * (c("n") - 1)).otherwise(c("part"))
        interest = F.when(c("k") % 19 == 0, F.floor((left * c("rate") * 8 + 3000) / 6000)).otherwise(
            F.floor((left * c("rate") + 600) / 1200))
        last = i == c("n") - 1
        paid = (
            F.when(c("status") == "repaid", ~((c("k") % 101 == 0) & last))
            .when(c("status") == "terminated", i < 2)
            .otherwise((due <= F.lit(TAPE_AS_OF)) & ~((c("k") % 23 == 0) & (i >= c("n") - 2)))
        )
        delay = (
            F.when((c("k") % 17 == 0) & last, 95).when(c("k") % 29 == 0, 20)
            .when((c("k") % 43 == 0) & last, 45).otherwise((c("k") * 7 + i * 3) % 4)
        )
        closure = c("early") & (i >= 1)
        actual = F.when(paid, F.when(closure, c("settled")).otherwise(F.date_add(due, delay.cast("int"))))
        state = F.when(paid, F.when(closure | (delay <= 5), "paid on time").otherwise("paid with delay")).otherwise(
            F.when(due < F.lit(TAPE_AS_OF), "pending late").otherwise("pending"))
        return F.struct(i.alias("i"), due.alias("due"), actual.alias("actual"), state.alias("state"),
                        paid.alias("paid"), principal.alias("principal"), interest.alias("interest"))

    base = base.withColumn("rows", F.transform(F.sequence(F.lit(0).cast("bigint"), c("n") - 1), row))
    as_json = c("k") % 5 == 0
    q = F.when(as_json, '"').otherwise("'")
    text = lambda v: F.concat(q, v, q)
    day = lambda d: F.coalesce(
        text(F.date_format(d, "dd/MM/yyyy")), F.when(as_json, "null").otherwise("None"))

    def record(owner: Column, due: Column, actual: Column, kind: str, state: Column, amount: Column,
               paid: Column) -> Column:
        pair = lambda key, v: F.concat(text(F.lit(key)), F.lit(": "), v)
        return F.concat(F.lit("{"), F.concat_ws(
            ", ", pair("Loan ID", text(owner.cast("string"))), pair("Payment date", day(due)),
            pair("Repayment date", day(actual)), pair("Type", text(F.lit(kind))), pair("State", text(state)),
            pair("Amount", _cents_text(amount)),
            pair("Pending amount", F.when(paid, F.lit("0")).otherwise(_cents_text(amount)))), F.lit("}"))

    owner = lambda i: c("k") + F.when((c("k") % 53 == 0) & (i == 0), 1).otherwise(0)
    records = F.flatten(F.transform("rows", lambda r: F.array(
        record(owner(r["i"]), r["due"], r["actual"], "principal", r["state"], r["principal"], r["paid"]),
        record(c("k"), r["due"], r["actual"], "interest", r["state"], r["interest"], r["paid"]))))
    closing = F.when(c("early"), F.array(record(
        c("k"), c("settled"), c("settled"), "full early repayment", F.lit("paid on time"), c("total") - c("part"),
        F.lit(True)))).otherwise(F.array().cast("array<string>"))
    total = lambda flag, name: F.aggregate(
        "rows", F.lit(0).cast("bigint"), lambda acc, r: acc + F.when(flag(r), r[name]).otherwise(0).cast("bigint"))
    base = base.withColumns({
        "cell": F.concat(F.lit("["), F.array_join(F.concat(records, closing), ", "), F.lit("]")),
        "open": total(lambda r: ~r["paid"], "principal"),
        "paid_interest": total(lambda r: r["paid"], "interest"),
        "open_interest": total(lambda r: ~r["paid"], "interest"),
        "last_actual": F.array_max(F.transform("rows", lambda r: r["actual"])),
        "first_open": F.array_min(F.transform("rows", lambda r: F.when(~r["paid"], r["due"]))),
        "first_interest": F.get("rows", F.lit(0))["interest"],
    })
    iso = lambda d: F.concat(d.cast("string"), F.lit("T00:00:00.000"))
    euros = F.floor(c("total") / 100)
    thousands, rest = F.floor(euros / 1000).cast("string"), F.lpad((euros % 1000).cast("string"), 3, "0")
    style = c("k") % 4
    amount = (
        F.when(c("k") % 89 == 0, "abc").when(style == 0, F.concat(thousands, F.lit("."), rest, F.lit(",00")))
        .when(style == 1, F.concat(thousands, F.lit(","), rest, F.lit(".00")))
        .when(style == 2, euros.cast("string")).otherwise(F.concat(F.lit("EUR "), euros.cast("string")))
    )
    outstanding = F.when(c("status") == "repaid", F.lit(0).cast("bigint")).otherwise(c("open"))
    business = c("cust") % 10 == 0
    col = lambda v, name: v.alias(name)
    return base.select(
        F.lit(TAPE_ID).alias("tape_id"), c("k").alias("source_row_index"),
        col(F.when(c("k") % 131 == 0, F.concat(F.lit("N/A-"), c("k").cast("string")))
            .when(c("k") % 7 == 0, F.concat(c("k").cast("string"), F.lit(".0")))
            .otherwise(c("k").cast("string")), "Loan ID"),
        col(c("cust").cast("string"), "Borrower ID"), col(amount, "Loan amount"),
        col(F.when((c("k") % 6 == 0) & (F.dayofmonth("start") > 12), F.date_format("start", "dd/MM/yyyy"))
            .otherwise(iso(c("start"))), "Disbursal date"),
        col(c("rate").cast("string"), "Interest rate"), col(c("n").cast("string"), "Loan term"),
        col(F.concat(F.initcap("status"), F.lit(" ")), "Loan status"),
        col(F.when(c("k") % 67 == 0, "garbage").when(c("k") % 71 == 0, F.lit(None).cast("string"))
            .when(c("k") % 73 == 0, "[]")
            .when(c("k") % 61 == 0, F.substring(c("cell"), F.lit(1), F.length("cell") - 30))
            .otherwise(c("cell")), "payments"),
        col(iso(F.add_months("start", (c("n") + F.when(c("k") % 47 == 0, 4).otherwise(0)).cast("int"))),
            "Expected repayment date"),
        col(F.lit("Instalment"), "Loan type"),
        col(F.when(business, "business").otherwise("Individual"), "Borrower type"),
        col(F.when(c("k") % 401 == 0, "z").otherwise("b"), "Credit score"),
        col(_cents_text(c("part") + c("first_interest")), "Monthly payment"),
        col(F.greatest(F.lit(0), F.coalesce(F.datediff(F.lit(TAPE_AS_OF), c("first_open")), F.lit(0))).cast("string"),
            "Days late"),
        col(_cents_text(outstanding), "Outstanding principal"),
        col(_cents_text(c("total") - outstanding - F.when(c("k") % 83 == 0, 500).otherwise(0)), "Repaid principal"),
        col(_cents_text(c("open_interest")), "Outstanding interest"),
        col(_cents_text(c("paid_interest")), "Repaid interest"),
        col(F.when((c("status") == "repaid") & (c("k") % 59 != 0), iso(c("last_actual"))), "Repayment date"),
        col(F.lit("0"), "Arrears"), col(F.lit("0.0"), "Delay interest"),
        col(F.when(c("k") % 97 == 0, "loan_purpose.2").otherwise("refinancing"), "Purpose"),
        col(F.when(~business | (c("cust") % 20 == 0), F.concat((1960 + c("cust") % 40).cast("string"), F.lit(".0"))),
            "Birth year"),
        col(F.lit(None).cast("string"), "Family income"), col(F.lit("2500"), "Borrower income"),
        col(F.lit("0"), "Family liabilities"), col(F.lit("1"), "Children"),
        col(F.lit("employed"), "Employment status"),
        col(F.lit(None).cast("string"), "Company age (years)"),
        col(F.lit("Vilnius"), "City"),
    )


def raw_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_tape(table(spark, sf_dir, "orders"))


RECORDS_IN_CELL = 120  # of the dialect cells; with them a cell stays below the usual limit of 32,767 characters


def dialect_cells(lineitem: DataFrame) -> DataFrame:
    """Cells of a hundred detail rows each, written in eight notations: (notation, cell, payments). Rows are packed by
    the place they are read at, so no order is gathered, however many rows it has."""
    c = F.col
    rows = lineitem.withColumns({
        "notation": F.pmod(c("l_orderkey") + c("l_partkey"), F.lit(8)), "cents": F.bround(c("l_extendedprice") * 100).cast("bigint"),
        "cell": F.floor(F.monotonically_increasing_id() / F.lit(RECORDS_IN_CELL * 8)),
    })
    n, q = c("notation"), F.when(c("notation").isin(1, 6), '"').otherwise("'")
    key, gap = c("l_orderkey").cast("string"), F.when(n == 4, " \t\n" * 6).otherwise(" ")
    whole, frac = F.floor(c("cents") / 100), F.lpad((c("cents") % 100).cast("string"), 2, "0")
    thousands = F.when(whole >= 1000, F.concat(F.floor(whole / 1000).cast("string"), F.lit("_"), F.lpad((whole % 1000).cast("string"), 3, "0")))
    euros = F.coalesce(F.when(n == 2, thousands), whole.cast("string"))
    loan = F.when(n == 3, F.concat(F.lit("'"), F.substring(key, 1, 1), F.lit("' # a note, 'None'\n '"), F.substring(key, F.lit(2), F.length(key)), F.lit("'"))).otherwise(F.concat(q, key, q))
    state = (
        F.when(n == 0, "'x: None, y'").when(n == 1, r'''"caf\u00e9 \"q\" \/ end"''').when(n == 5, r"""'inter\x65st \xe9 \'q\' \\ \101 \d'""")
        .when(n == 6, '''"it's: True, so"''').otherwise("'plain'"))
    none = F.when(n == 1, "null").otherwise("None")
    pending = F.when(n == 7, "-.5").when(n == 2, "5.").when(n == 4, "+7").otherwise("0")
    pair = lambda name, value: F.concat(q, F.lit(name), q, F.lit(":"), gap, value, gap)
    record = F.concat(F.lit("{"), F.concat_ws(
        ", ", pair("Loan ID", loan), pair("Payment date", F.concat(q, F.date_format("l_shipdate", "dd/MM/yyyy"), q)), pair("Repayment date", none),
        pair("Type", F.concat(q, F.lit("interest"), q)), pair("State", state), pair("Amount", F.concat(euros, F.lit("."), frac)),
        pair("Pending amount", pending)), F.when(n == 4, " , }").otherwise("}"))
    return rows.groupBy("notation", "cell").agg(F.collect_list(record).alias("r")).select(
        "notation", "cell", F.concat(F.lit("[ "), F.array_join("r", ", "), F.when(c("notation") == 4, ",\n]").otherwise(" ]")).alias("payments"))
