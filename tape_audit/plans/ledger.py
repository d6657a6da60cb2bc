"""Raw tape to typed loans, quarantine and payments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tape_audit.config import Policy, Section, section
from tape_audit.functions import normalize as N
from tape_audit.operators import conventions as C
from tape_audit.operators import diary
from tape_audit.operators.staging import stage, stage_by
from tape_audit.session import spread, tuned

KEY = C.KEY


class TapeRefusedError(ValueError):
    """The tape cannot be audited: schema broken, or no usable row."""


class NoAuditDateError(ValueError):
    """No as-of date was given and none can be inferred."""


# Typed name, kind, raw column.
LOAN_FIELDS: tuple[tuple[str, str, str], ...] = (
    ("loan_amount", "float", "Loan amount"),
    ("disbursal_date", "date", "Disbursal date"),
    ("interest_rate", "float", "Interest rate"),
    ("loan_term_months", "int", "Loan term"),
    ("expected_repayment_date", "date", "Expected repayment date"),
    ("monthly_payment", "float", "Monthly payment"),
    ("days_late", "int", "Days late"),
    ("outstanding_principal", "float", "Outstanding principal"),
    ("repaid_principal", "float", "Repaid principal"),
    ("outstanding_interest", "float", "Outstanding interest"),
    ("repaid_interest", "float", "Repaid interest"),
    ("repayment_date", "date", "Repayment date"),
    ("arrears", "float", "Arrears"),
    ("delay_interest", "float", "Delay interest"),
    ("birth_year", "int", "Birth year"),
    ("family_income", "float", "Family income"),
    ("borrower_income", "float", "Borrower income"),
    ("family_liabilities", "float", "Family liabilities"),
    ("children", "float", "Children"),
    ("company_age_years", "float", "Company age (years)"),
    ("loan_type", "text", "Loan type"),
    ("borrower_type", "text", "Borrower type"),
    ("credit_score", "text", "Credit score"),
    ("loan_status", "text", "Loan status"),
    ("purpose", "text", "Purpose"),
    ("employment_status", "text", "Employment status"),
)
READINGS = {
    "disbursal_date": "disbursal_readings",
    "expected_repayment_date": "expected_readings",
    "repayment_date": "repayment_readings",
}
_CASE = {"loan_type": F.lower, "borrower_type": F.lower, "loan_status": F.lower,
         "employment_status": F.lower, "credit_score": F.upper}

PAYMENT_BASE = [
    *KEY, "loan_id", "payment_seq", "copies", "record_loan_id", "due_date", "actual_date",
    "due_fmt", "actual_fmt", "type", "state", "is_paid", "amount", "pending_amount", "issues",
]


@dataclass(frozen=True)
class SchemaCheck:
    present: tuple[str, ...]
    required_missing: tuple[str, ...]
    optional_missing: tuple[str, ...]
    unexpected: tuple[str, ...]
    duplicated: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.required_missing and not self.duplicated


@dataclass(frozen=True)
class Ledger:
    """Loans and their payment records. ``giant_loans`` marks a flat source where one loan is not bounded
    by a text cell, so plans must not gather a loan into one task. Otherwise the payments are dealt by hash of their row
    into ``parts``, and stay so when they are stored."""

    loans: DataFrame
    payments: DataFrame
    quarantine: DataFrame | None = None
    missing_columns: frozenset[str] = field(default_factory=frozenset)
    giant_loans: bool = False
    as_of: date | None = None
    parts: int | None = None

    def prepared(self) -> Ledger:
        """Payments with convention tags and subset columns."""
        tagged = C.tag_conventions(self.payments, giant_loans=self.giant_loans)
        return replace(self, payments=C.add_subsets(tagged, self.as_of))

    def staged(self) -> Ledger:
        """Prepared payments, stored for several readers."""
        ready = self.prepared().payments
        if self.giant_loans or self.parts is None:
            return replace(self, payments=stage(ready, "payments"))
        return replace(self, payments=stage_by(ready, "payments", "source_row_index", self.parts))


def check_schema(columns: list[str], dictionary: Section = section("dictionary")) -> SchemaCheck:
    present = [c.strip() for c in columns]
    known = set(dictionary.required_columns) | set(dictionary.optional_columns)
    return SchemaCheck(
        tuple(present),
        tuple(c for c in dictionary.required_columns if c not in present),
        tuple(c for c in dictionary.optional_columns if c not in present),
        tuple(c for c in present if c not in known and not c.startswith("Unnamed:")
              and c not in KEY),
        tuple(sorted({c for c in present if present.count(c) > 1})),
    )


def _typed_source(raw: DataFrame, name: str, kind: str) -> Column | None:
    """Struct for a cell that arrives typed (Parquet), or None when it must be parsed as text."""
    dtype = raw.schema[name].dataType
    if kind == "date" and isinstance(dtype, T.DateType):
        return N.typed_date(F.col(f"`{name}`"), "date")
    if kind == "date" and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return N.typed_date(F.col(f"`{name}`"), "datetime")
    return None


def to_loans(raw: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Typed projection of the raw tape, one row per input row, with all parse issues collected and the
    payment history decoded into ``records``. Needs the key columns; absent optional columns read NULL."""
    names = set(raw.columns)
    absent = [c for c in policy.dictionary.optional_columns if c not in names]
    raw = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])
    required = policy.dictionary.required_columns
    raw = raw.withColumn("_blank", F.array_compact(F.array(*[
        F.when(N.is_missing(F.col(f"`{c}`").cast("string")) if c != "payments"
               else F.col(c).isNull() if isinstance(raw.schema[c].dataType, T.ArrayType)
               else N.is_missing_cell(F.col(c)), F.lit(c))
        for c in required
    ])))
    raw = diary.parse_nested(raw, "payments", policy.tape.cell_limit)
    spec: dict[str, tuple[str, Column]] = {
        "_id": ("id", F.col("`Loan ID`")), "_borrower": ("id", F.col("`Borrower ID`")),
    }
    typed: dict[str, Column] = {}
    for out, kind, column in LOAN_FIELDS:
        source = _typed_source(raw, column, kind)
        if source is None:
            spec[out] = (kind, F.col(f"`{column}`"))
        else:
            typed[out] = source
    raw = raw.select("*", *[c.alias(f"_typed_{n}") for n, c in typed.items()])
    facts = ["records", "diary_raw_chars", "diary_truncated", "diary_error", "dropped_tail_chars",
             "_blank", *[f"_typed_{n}" for n in typed]]
    parsed = N.type_columns(raw, spec, [*KEY, *facts])
    parsed = parsed.withColumnsRenamed({f"_typed_{n}": n for n in typed})
    issue = lambda name, problem: F.struct(
        F.lit(name).alias("field"), problem.alias("problem"))
    blanks = F.transform("_blank", lambda b: F.struct(
        b.alias("field"), F.lit("required value is missing").alias("problem")))
    problems = F.array_compact(F.array(*[
        F.when(F.col(f"{out}.error").isNotNull(), issue(column, F.col(f"{out}.error")))
        for out, kind, column in LOAN_FIELDS if kind != "text"
    ]))
    values = []
    for out, kind, _ in LOAN_FIELDS:
        if kind == "text":
            values.append(_CASE.get(out, lambda c: c)(F.col(out)).alias(out))
        else:
            values.append(F.col(f"{out}.value").alias(out))
            if kind == "date":
                values.append(F.col(f"{out}.readings").alias(READINGS[out]))
    borrower = F.coalesce(
        F.col("_borrower.value").cast("string"),
        F.when(F.col("_borrower.text") != "", F.col("_borrower.text")),
    )
    return parsed.select(
        *KEY,
        F.col("_id.value").alias("loan_id"), F.col("_id.text").alias("loan_id_raw"),
        borrower.alias("borrower_id"), *values,
        F.concat(blanks, problems).alias("parse_issues"),
        "diary_raw_chars", "diary_truncated", "diary_error", "dropped_tail_chars",
        F.coalesce(F.size("records"), F.lit(0)).cast("bigint").alias("n_records"),
        "records",
    ).withColumn("n_records", F.greatest("n_records", F.lit(0).cast("bigint")))


def split_quarantine(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an integer loan id are set aside with a reason; the others go on."""
    usable = typed.filter("loan_id IS NOT NULL")
    quarantine = typed.filter("loan_id IS NULL").select(
        *KEY, "loan_id_raw", F.lit("loan number absent or not whole").alias("reason")
    )
    return usable, quarantine


def to_payments(loans: DataFrame) -> DataFrame:
    exploded = diary.explode_nested(loans, [*KEY, "loan_id"])
    return diary.type_records(exploded, [*KEY, "loan_id"]).select(*PAYMENT_BASE)


def build_ledger(raw: DataFrame, policy: Policy = Policy(), as_of: date | None = None,
                 stager: Callable[[DataFrame], DataFrame] | None = None) -> Ledger:
    """Raw all-text tape with key columns to a ledger. Schema faults reject the whole tape. ``stager`` stores
    the typed rows, so that the text is decoded once however many plans read them."""
    schema = check_schema(raw.columns, policy.dictionary)
    if not schema.ok:
        raise TapeRefusedError(
            f"tape rejected: missing {list(schema.required_missing)}, duplicated {list(schema.duplicated)}"
        )
    n = spread(tuned(raw.sparkSession))
    if stager is None:
        # the one exchange of the plan: compact text rows, before they are exploded. Only the row position is
        # hashed: a constant tape_id is folded away, and clustering by a part of the key serves the whole key.
        typed = by_loan = to_loans(raw.repartition(n, "source_row_index"), policy)
    else:
        # few splits of a small file hold many cells: without an exchange of their own one task would decode them all
        typed = stager(to_loans(raw.repartition(n, "source_row_index"), policy))
        by_loan = typed.repartition(n, "source_row_index")
    loans, quarantine = split_quarantine(typed)
    return Ledger(
        loans=loans.drop("records"), payments=to_payments(split_quarantine(by_loan)[0]), quarantine=quarantine,
        missing_columns=frozenset(schema.optional_missing), as_of=as_of or policy.as_of, parts=n,
    )


def observed_dates(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct dates that can bear an as-of date; due dates lie in the future and do not count."""
    summary = loans.select(F.explode(F.array("disbursal_date", "repayment_date")).alias("d"))
    return summary.union(payments.select(F.col("actual_date").alias("d"))).filter(
        "d IS NOT NULL"
    ).distinct()


def infer_as_of(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """One row: latest observed date and its distance to the next-latest one."""
    top = observed_dates(loans, payments).orderBy(F.desc("d")).limit(2)
    return top.agg(
        F.max("d").alias("as_of"),
        F.when(F.count("d") == 2, F.datediff(F.max("d"), F.min("d"))).alias("gap_days"),
    )


def resolve_as_of(ledger: Ledger, policy: Policy) -> tuple[date, str]:
    """The configured date wins; an inferred one that stands alone is called out."""
    if policy.as_of is not None:
        return policy.as_of, "config"
    row = infer_as_of(ledger.loans, ledger.payments).first()
    if row is None or row.as_of is None:
        raise NoAuditDateError("cannot infer an as-of date: the tape holds no observed date")
    source = "inferred:max_date_in_tape"
    if row.gap_days is not None and row.gap_days > policy.tolerance.as_of_isolated_days:
        source += f" (isolated: next-latest date is {row.gap_days} days earlier)"
    return row.as_of, source


def _located(df: DataFrame) -> DataFrame:
    """Each row with its file, its split of that file, and a number that grows with its place inside the split."""
    place = F.monotonically_increasing_id().alias("_place")
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), place)
    except AnalysisException:  # not a scan of files: its partitions in their order
        return df.select("*", place).select("*", F.lit("").alias("_file"), F.shiftright("_place", 33).alias("_split"))


def with_row_index(df: DataFrame) -> DataFrame:
    """Contiguous 0-based source position of the rows: files by name, rows as they stand in each. How Spark packs splits
    into tasks has no part in it. Rows are counted per split first; a row's position is its split's offset and its place
    inside. All of it stays in the JVM, no row is sorted or shuffled, and the offsets are one row per split."""
    if "source_row_index" in df.columns:
        return df
    placed = _located(df)
    splits = placed.select("_file", "_split", "_place").groupBy("_file", "_split").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    return placed.join(offsets, ["_file", "_split"]).select(
        *(F.col(f"`{c}`") for c in df.columns), (F.col("_offset") + F.col("_place")).alias("source_row_index"))


def dense_position(df: DataFrame, keys: list[str], order: list[str], spread: Column, out: str) -> DataFrame:
    """Unique small positions within a group that need not fit into one task: rows are numbered inside
    ``spread`` buckets and the buckets interleaved. ``spread`` must be an integer in 0..255."""
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        df.withColumn("_bucket", spread.cast("bigint"))
        .withColumn(out, (F.row_number().over(w).cast("bigint") - 1) * 256 + F.col("_bucket"))
        .drop("_bucket")
    )
