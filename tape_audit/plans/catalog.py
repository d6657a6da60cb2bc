"""The rule catalogue: metadata of the 50 per-loan checks, in evaluation order.

Record-consistency rules come first, then repayment-behaviour rules; ``ordinal`` is the position in
that order and decides ties (first finding, lead reason).
"""

from __future__ import annotations

from dataclasses import dataclass

RULESET_VERSION = "tape-audit-1"

RECORD = "record_consistency"
BEHAVIOUR = "repayment_behaviour"
WHOLE_TAPE = "whole_tape"


@dataclass(frozen=True)
class RuleInfo:
    rule_id: str
    category: str
    severity: str
    axis: str = "integrity"
    subsumed_by: tuple[str, ...] = ()

    @property
    def group(self) -> str:
        return check_group(self.rule_id)


def check_group(rule_id: str) -> str | None:
    """Inspection group of a rule id (loan rules and whole-tape checks)."""
    if rule_id == "C8" or rule_id[:1] in ("F", "G"):
        return BEHAVIOUR
    if rule_id[:1] == "I":
        return WHOLE_TAPE
    return RECORD if rule_id[:1] in ("A", "B", "C", "D", "E", "H") else None


# Id, category, default severity, axis, rules whose failure explains this one.
_READABILITY = [
    RuleInfo("A2", "readability", "high"),
    RuleInfo("A3", "readability", "high"),
    RuleInfo("A4", "readability", "high"),
    RuleInfo("A5", "readability", "medium", subsumed_by=("A7",)),
    RuleInfo("A6", "readability", "medium"),
    RuleInfo("A7", "readability", "high"),
    RuleInfo("A8", "readability", "info", "coverage", ("A7",)),
    RuleInfo("A9", "readability", "medium", subsumed_by=("A7",)),
    RuleInfo("A10", "readability", "high", subsumed_by=("A7",)),
]
_IDENTITY = [
    RuleInfo("B1", "identity", "high"),
    RuleInfo("B2", "identity", "critical"),
    RuleInfo("B3", "identity", "high", subsumed_by=("E1", "B1")),
    RuleInfo("B4", "identity", "high", subsumed_by=("E1",)),
    RuleInfo("B5", "identity", "high", subsumed_by=("E1", "B4")),
    RuleInfo("B6", "identity", "medium"),
    RuleInfo("B7", "identity", "medium", subsumed_by=("F2", "E1")),
    RuleInfo("B11", "identity", "medium"),
]
_ARITHMETIC = [
    RuleInfo("C1", "arithmetic", "medium", subsumed_by=("C2", "F1", "F2")),
    RuleInfo("C2", "arithmetic", "high", subsumed_by=("B1", "F1", "F2")),
    RuleInfo("C4", "arithmetic", "critical"),
    RuleInfo("C5", "arithmetic", "high"),
    RuleInfo("C6", "arithmetic", "high"),
    RuleInfo("C9", "arithmetic", "medium"),
    RuleInfo("C10", "arithmetic", "medium"),
]
_TEMPORAL = [
    RuleInfo("D1", "temporal", "high"),
    RuleInfo("D2", "temporal", "high"),
    RuleInfo("D3", "temporal", "medium"),
    RuleInfo("D4", "temporal", "medium", subsumed_by=("E1",)),
    RuleInfo("D5", "temporal", "high"),
    RuleInfo("D6", "temporal", "medium", subsumed_by=("E1",)),
    RuleInfo("D7", "temporal", "low"),
    RuleInfo("D8", "temporal", "low"),
]
_LIFECYCLE = [
    RuleInfo("E1", "lifecycle", "high"),
    RuleInfo("E2", "lifecycle", "high"),
    RuleInfo("E3", "lifecycle", "high", subsumed_by=("F2",)),
    RuleInfo("E4", "lifecycle", "high"),
    RuleInfo("E5", "lifecycle", "high", subsumed_by=("E1",)),
]
_PLAUSIBILITY = [
    RuleInfo("H1", "plausibility", "medium"),
    RuleInfo("H3", "plausibility", "low"),
    RuleInfo("H4", "plausibility", "medium"),
    RuleInfo("H5", "plausibility", "high"),
    RuleInfo("H9", "plausibility", "medium"),
    RuleInfo("H10", "plausibility", "low"),
]
_CREDIT = [
    RuleInfo("C8", "arithmetic", "medium", "credit", ("F2",)),
    RuleInfo("F1", "lateness", "high", "credit"),
    RuleInfo("F2", "lateness", "critical", "credit"),
    RuleInfo("F3", "lateness", "medium", "credit", ("F1", "F2")),
    RuleInfo("G6", "behaviour", "info", "credit", ("F1", "F2", "F3")),
    RuleInfo("G7", "behaviour", "low", "credit", ("F2", "F3")),
    RuleInfo("G8", "behaviour", "low", "credit", ("F1", "F2", "F3")),
]

RULES: tuple[RuleInfo, ...] = tuple(
    _READABILITY + _IDENTITY + _ARITHMETIC + _TEMPORAL + _LIFECYCLE + _PLAUSIBILITY + _CREDIT
)
RULE_IDS: tuple[str, ...] = tuple(r.rule_id for r in RULES)
ORDINAL: dict[str, int] = {r.rule_id: i for i, r in enumerate(RULES)}
BY_ID: dict[str, RuleInfo] = {r.rule_id: r for r in RULES}

SEVERITY_RANK = {"info": 0, "low": 1, "medium": 2, "high": 3, "critical": 4}
DEFAULT_RULES = ("F1", "F2")
WATCH_RULES = ("F3", "C8", "G7")
EVIDENCE_CATEGORIES = ("identity", "arithmetic", "temporal", "lifecycle", "lateness")
