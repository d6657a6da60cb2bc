"""The whole audit of one tape: raw rows in, a family of tables out.

Four tables are staged on shared storage because several others read them: typed rows, prepared payments (one
exchange on the loan key), assessed loans, and verdicts. Everything else is lazy.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tape_audit.config import Policy
from tape_audit.operators.staging import stage
from tape_audit.plans import judgement, rules, tables
from tape_audit.plans.catalog import RULESET_VERSION
from tape_audit.plans.evidence import ROW_EVIDENCE, repeated_ids, row_evidence
from tape_audit.plans.health import combine, finish, partial
from tape_audit.plans.ledger import KEY, Ledger, TapeRefusedError, build_ledger, check_schema, resolve_as_of
from tape_audit.plans.rollups import (
    check_groups, publication_status, row_accounting, tier_shares, triage_rank, verdict_rollup,
)
from tape_audit.plans.tape_checks import (
    ROW_IDENTITY, TapeFacts, amount_profile, fact_checks, flagged_profile, shared_row_members, tape_facts, tape_findings,
)
from tape_audit.sources import sinks

VERDICT_KEEP = [*KEY, "loan_id", "loan_status"]


@dataclass(frozen=True)
class Audit:
    ledger: Ledger
    tape_id: str
    as_of: date
    as_of_source: str
    assessed: DataFrame
    results: DataFrame
    quarantine: DataFrame
    tables: dict[str, DataFrame]


@dataclass(frozen=True)
class RowAudit:
    ledger: Ledger
    as_of: date
    as_of_source: str
    assessed: DataFrame
    state: dict[str, DataFrame]


def assess_ledger(ledger: Ledger, policy: Policy = Policy(), told: bool = True) -> tuple[Ledger, DataFrame]:
    """Prepare and stage payments, then stage one assessed row per loan; without ``told`` only what ``verdicts`` reads that
    are not ``told`` either, so the features that only texts and tables show are not made."""
    ledger = ledger.staged()
    parts = rules.PARTS if told else tuple(p for p in rules.PARTS if p not in rules.TOLD_PARTS)
    assessed = judgement.verdict_inputs(rules.assess(ledger, policy, parts))
    return ledger, stage(assessed if told else assessed.drop(*rules.TOLD_COLUMNS), "assessed")


def verdicts(assessed: DataFrame, ledger: Ledger, policy: Policy = Policy(), told: bool = True) -> DataFrame:
    """Verdicts of all loans; without ``told`` they carry no messages, evidence, reasons and residuals."""
    keep = [*VERDICT_KEEP, "diary_error", "evidence_complete"]
    evaluated = rules.evaluate(assessed, policy, ledger.missing_columns, ledger.as_of, keep, told)
    return judgement.judge(evaluated, policy, VERDICT_KEEP)


def run_id(tape_digest: str, policy: Policy, as_of: date) -> str:
    """Identity of a run: the same source, policy, rules and date give the same id."""
    parts = {"source": tape_digest, "policy": policy.digest(), "ruleset": RULESET_VERSION,
             "as_of": as_of.isoformat()}
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]


def tape_of(raw: DataFrame) -> str:
    """The tape that the rows belong to; one audit is of one tape."""
    row = raw.select("tape_id").first()
    if row is None:
        raise TapeRefusedError("tape rejected: no rows")
    return row["tape_id"]


def audit_rows(raw: DataFrame, policy: Policy = Policy()) -> RowAudit:
    """All that rows yield without the rest of their tape. ``raw`` carries ``tape_id`` and ``source_row_index``; rows
    without a usable loan are rejected unless the policy pins the as-of date."""
    ledger = build_ledger(raw, policy, stager=lambda typed: stage(typed, "typed"))
    quarantine = ledger.quarantine
    if policy.as_of is None and ledger.loans.isEmpty():
        raise TapeRefusedError("tape rejected: no usable row")
    as_of, source = resolve_as_of(ledger, policy)
    ledger, assessed = assess_ledger(replace(ledger, as_of=as_of), policy)
    results = stage(verdicts(assessed, ledger, policy), "results")
    facts = tape_facts(ledger.loans, ledger.payments, policy)
    state = {
        "rows": raw.select(*KEY), "results": results, "quarantine": quarantine,
        "payments": tables.payments_table(ledger, policy), "coverage": tables.coverage_table(assessed, policy, as_of),
        "profile": tables.profile_table(assessed), **row_evidence(ledger, policy),
        "loan_facts": facts.loans, "paid_facts": facts.paid, "round_facts": facts.rounds,
        "health": partial(raw, ledger.loans, ledger.payments, quarantine, policy),
    }
    return RowAudit(ledger, as_of, source, assessed, state)


def finish_audit(state: dict[str, DataFrame], policy: Policy, columns: list[str], tape: str, tape_digest: str,
                 as_of: date, source: str) -> dict[str, DataFrame]:
    """The published tables of a tape out of the state of its rows: one part or the union of many."""
    results, quarantine = state["results"], state["quarantine"]
    facts = TapeFacts(state["loan_facts"], state["paid_facts"], state["round_facts"])
    checks = stage(fact_checks(facts, results, policy), "checks")
    outcomes = judgement.long_outcomes(results)
    status = publication_status(results, checks, row_accounting(state["rows"], results, quarantine))
    run = run_id(tape_digest, policy, as_of)
    out = {
        "summary": sinks.summary_table(results, quarantine),
        "loan_results": judgement.public_results(results),
        "rule_outcomes": outcomes,
        "findings": judgement.long_findings(results),
        **{name: state[name] for name in ("payments", "coverage", "profile", *ROW_EVIDENCE)},
        "repeated_ids": repeated_ids(facts.loans), "shared_records": shared_row_members(facts.paid, ROW_IDENTITY, "loan_id"),
        "tape_checks": checks, "tape_findings": tape_findings(checks), "amount_profile": amount_profile(facts, policy),
        "flagged_profile": flagged_profile(results),
        "health": finish(combine(state["health"]), check_schema(columns, policy.dictionary), source),
        "quarantine": sinks.quarantine_table(quarantine),
        "rollup": verdict_rollup(results), "tiers": tier_shares(results), "check_groups": check_groups(outcomes, checks),
        "triage": triage_rank(results),
        "run": status.select(
            F.lit(tape_digest).alias("tape_digest"), F.lit(as_of).alias("as_of"), F.lit(source).alias("as_of_source"),
            F.lit(RULESET_VERSION).alias("ruleset_version"), F.lit(policy.digest()).alias("policy_digest"), *status.columns),
    }
    return {name: df.withColumns({"tape_id": F.lit(tape), "run_id": F.lit(run)}) for name, df in out.items()}


def data_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in KEY]


def audit(raw: DataFrame, policy: Policy = Policy(), tape_digest: str | None = None) -> Audit:
    """``raw`` carries ``tape_id`` and ``source_row_index``. A tape without a usable row is rejected."""
    rows = audit_rows(raw, policy)
    tape = tape_of(raw)
    out = finish_audit(rows.state, policy, data_columns(raw), tape, tape_digest or "unknown", rows.as_of, rows.as_of_source)
    return Audit(rows.ledger, tape, rows.as_of, rows.as_of_source, rows.assessed, rows.state["results"],
                 rows.state["quarantine"], out)


def write_audit(result: Audit, folder: str, fmt: str = "parquet") -> None:
    """Publishes every table; tapes published before into the same folder are not touched."""
    for name, df in result.tables.items():
        sinks.publish_table(df, f"{folder}/{name}", result.tape_id, fmt)
