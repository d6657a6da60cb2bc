"""Audit policy: thresholds and vocabularies, validated on the driver.

Every value ends up as a literal in the logical plan, so Catalyst can fold it. The policy digest is
stamped on every output so that two runs with different thresholds are never merged.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from operator import le, lt
from typing import Any, NamedTuple


class PolicyError(ValueError):
    """The policy is malformed or contradicts itself."""


# The raw tape's data dictionary and controlled vocabularies.
REQUIRED_COLUMNS = (
    "Loan ID", "Borrower ID", "Loan amount", "Disbursal date",
    "Interest rate", "Loan term", "Loan status", "payments",
)
OPTIONAL_COLUMNS = (
    "Expected repayment date", "Loan type", "Borrower type", "Credit score",
    "Monthly payment", "Days late", "Outstanding principal", "Repaid principal",
    "Outstanding interest", "Repaid interest", "Repayment date", "Arrears",
    "Delay interest", "Purpose", "Birth year", "Family income", "Borrower income",
    "Family liabilities", "Children", "Employment status", "Company age (years)",
)
LOAN_STATUSES = ("granted", "repaid", "terminated")
LOAN_TYPES = ("instalment", "deferred annuity")
BORROWER_TYPES = ("individual", "business")
CREDIT_SCORES = ("A", "B", "C", "D")
SEVERITIES = ("info", "low", "medium", "high", "critical")
PURPOSE_CODE = r"^loan_purpose\.\d+$"


class Setting(NamedTuple):
    """One row of the policy's table: the type of the default is the type of the setting."""

    default: Any
    low: float | None = 0
    high: float | None = None
    unit: str = ""


def _days(n: int, low: int = 0) -> Setting:
    return Setting(n, low, None, "days")


def _count(n: int, low: int = 1) -> Setting:
    return Setting(n, low)


def _share(x: float) -> Setting:
    return Setting(x, 0, 1, "share")


def _euros(x: float) -> Setting:
    return Setting(x, 0, None, "EUR")


# The names of all settings, which policy files use, in alphabetical order, with defaults and bounds.
SETTINGS: dict[str, dict[str, Setting]] = {
    "dictionary": {
        "borrower_type_values": Setting(BORROWER_TYPES, 1),
        "credit_score_values": Setting(CREDIT_SCORES, 1),
        "loan_status_values": Setting(LOAN_STATUSES, 1),
        "loan_type_values": Setting(LOAN_TYPES, 1),
        "optional_columns": Setting(OPTIONAL_COLUMNS),
        "purpose_code_pattern": Setting(PURPOSE_CODE, None),
        "required_columns": Setting(REQUIRED_COLUMNS, 1),
    },
    "irr": {
        "gap_percentage_points": Setting(5.0, 0, None, "points"),
        "gap_relative": _share(0.40),
        "high_rate_ceiling": Setting(10.0, None),
        "low_rate_floor": Setting(-0.99, None),
        "min_inflows": _count(3),
        "min_realised_interest_share": _share(0.10),
    },
    "lateness": {
        "default_days": _days(90),
        "drift_min_exceeding": _count(2),
        "drift_recent_episodes": _count(3),
        "grace_days": _days(5),
        "habitual_late_share": _share(0.5),
        "medium_days": _days(30),
        "trend_min_paid": _count(6, 2),
        "watch_flag_days": _days(60),
    },
    "plausibility": {
        "max_age": _count(100, 0),
        "max_interest_rate": Setting(100.0),
        "max_payment_to_income": Setting(1.0),
        "max_term_months": _count(360),
        "min_age": _count(18, 0),
        "min_interest_rate": Setting(0.0),
        "min_term_months": _count(1),
    },
    "tape": {
        "benford_max_mad": _share(0.015),
        "benford_min_loans": _count(200),
        "benford_min_sample": _count(500),
        "cell_limit": _count(32767),
        "circuit_breaker_share": _share(0.40),
        "duplicate_amount_floor_eur": _euros(50.0),
        "round_min_days_late": _days(30, 1),
        "round_min_sample": _count(100),
        "round_share_max": _share(0.10),
    },
    "tolerance": {
        "amount_eur": _euros(0.50),
        "as_of_isolated_days": _days(45),
        "days_late_days": _days(5),
        "expected_repayment_days": _days(45),
        "grace_state_days": _days(15),
        "instalment_interest_eur": _euros(0.50),
        "instalment_interest_rel": _share(0.15),
        "interest_eur": _euros(1.00),
        "principal_gap_material_share": _share(0.10),
        "repayment_date_slack_days": _days(3),
        "schedule_gap_days": _days(45),
        "schedule_min_gap_days": _days(20),
    },
}

#: Settings of a section, or numbers, that must stand in this order.
ORDER = (
    ("lateness", "grace_days < medium_days <= watch_flag_days < default_days"),
    ("lateness", "drift_min_exceeding <= drift_recent_episodes"),
    ("tolerance", "schedule_min_gap_days < schedule_gap_days"),
    ("irr", "-1.0 < low_rate_floor < high_rate_ceiling"),
    ("plausibility", "min_age <= max_age"),
    ("plausibility", "min_interest_rate <= max_interest_rate"),
    ("plausibility", "min_term_months <= max_term_months"),
)


class Section:
    """Values of one group of settings, read as attributes."""

    def __init__(self, values: Mapping[str, Any]) -> None:
        object.__setattr__(self, "_values", dict(values))

    def __getattr__(self, name: str) -> Any:
        if name.startswith("_") or name not in self._values:
            raise AttributeError(name)
        return self._values[name]

    def __setattr__(self, name: str, value: Any) -> None:
        raise AttributeError("a policy does not change")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Section) and self._values == other._values

    def __hash__(self) -> int:
        return hash(tuple(sorted(self._values.items())))

    def as_dict(self) -> dict[str, Any]:
        return dict(self._values)


def _refuse(unless: bool, text: str) -> None:
    if not unless:
        raise PolicyError(text)


def _read(where: str, value: Any, setting: Setting) -> Any:
    """A value of the setting's type and within its bounds; for names, the bounds are of their number."""
    kind = type(setting.default)
    if kind is tuple:
        _refuse(isinstance(value, (list, tuple)) and all(isinstance(v, str) and v.strip() for v in value), f"{where}: a list of nonblank names is needed")
        _refuse(len(set(value)) == len(value), f"{where}: a name stands twice")
        _refuse(len(value) >= setting.low, f"{where}: at least {setting.low} names are needed")
        return tuple(value)
    if kind is str:
        _refuse(isinstance(value, str), f"{where}: a text is needed")
        return value
    number = isinstance(value, int if kind is int else (int, float)) and not isinstance(value, bool)
    _refuse(number and math.isfinite(value), f"{where}: a finite {'whole ' if kind is int else ''}number is needed")
    _refuse((setting.low is None or value >= setting.low) and (setting.high is None or value <= setting.high),
            f"{where}: {value} is outside {setting.low} to {setting.high} {setting.unit}".rstrip())
    return kind(value)


def section(name: str, given: Any = None) -> Section:
    """The settings of a section: what is given, read strictly, over the defaults."""
    given = {} if given is None else given
    _refuse(isinstance(given, Mapping), f"{name}: a mapping is needed")
    unknown = sorted(set(given) - set(SETTINGS[name]))
    _refuse(not unknown, f"{name}: no setting is called {', '.join(map(str, unknown))}")
    values = {key: _read(f"{name}.{key}", given.get(key, s.default), s) for key, s in SETTINGS[name].items()}
    for own, chain in ORDER:
        if own == name:
            words = chain.split()
            terms = [values[w] if w in values else float(w) for w in words[::2]]
            held = all({"<": lt, "<=": le}[op](a, b) for a, op, b in zip(terms, words[1::2], terms[1:], strict=False))
            _refuse(held, f"{name}: {chain} does not hold")
    return Section(values)


@dataclass(frozen=True)
class Policy:
    """All settings of an audit. Sections are attributes: ``policy.lateness.grace_days``."""

    lender: str = "default"
    as_of: date | None = None
    flag_min_severity: str = "medium"
    disabled_rules: tuple[str, ...] = ()
    info_only_rules: tuple[str, ...] = ()
    sections: Mapping[str, Section] = field(default_factory=lambda: {name: section(name) for name in SETTINGS}, hash=False)

    def __post_init__(self) -> None:
        from tape_audit.plans.catalog import RULE_IDS

        _refuse(self.flag_min_severity in SEVERITIES, "flag_min_severity: no such severity")
        for name in ("disabled_rules", "info_only_rules"):
            ids = _read(name, getattr(self, name), Setting(()))
            _refuse(set(ids) <= set(RULE_IDS), f"{name}: there is no rule {', '.join(sorted(set(ids) - set(RULE_IDS)))}")
            object.__setattr__(self, name, ids)
        names = self.dictionary
        both = sorted(set(names.required_columns) & set(names.optional_columns))
        _refuse(not both, f"dictionary: {', '.join(both)} cannot be required and optional at once")
        try:
            re.compile(names.purpose_code_pattern)
        except re.error as exc:
            raise PolicyError("dictionary.purpose_code_pattern: not a regular expression") from exc

    def __getattr__(self, name: str) -> Section:
        if name.startswith("_") or name not in SETTINGS:
            raise AttributeError(name)
        return self.sections[name]

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any] | None) -> Policy:
        """Strict load: an unknown key, a wrong type or a non-finite number is an error."""
        raw = {} if raw is None else raw
        _refuse(isinstance(raw, Mapping), "policy: a mapping is needed")
        own = {"lender", "as_of", "flag_min_severity", "disabled_rules", "info_only_rules"}
        unknown = sorted(set(raw) - own - set(SETTINGS))
        _refuse(not unknown, f"policy: no setting is called {', '.join(map(str, unknown))}")
        values = {k: raw[k] for k in own & set(raw)}
        for key in {"lender", "flag_min_severity"} & set(values):
            _refuse(isinstance(values[key], str), f"{key}: a text is needed")
        if isinstance(values.get("as_of"), str):
            try:
                values["as_of"] = date.fromisoformat(values["as_of"])
            except ValueError as exc:
                raise PolicyError("as_of: an ISO date is needed") from exc
        _refuse(values.get("as_of") is None or isinstance(values["as_of"], date), "as_of: a date is needed")
        return cls(**values, sections={name: section(name, raw.get(name)) for name in SETTINGS})

    @classmethod
    def load(cls, path: str | None) -> Policy:
        if path is None:
            return cls()
        try:
            with open(path, encoding="utf-8") as fh:
                raw = json.load(fh)
        except (OSError, ValueError) as exc:
            raise PolicyError(f"the policy file is not readable ({type(exc).__name__})") from exc
        return cls.from_dict(raw)

    def digest(self) -> str:
        plain = {n: getattr(self, n) for n in ("lender", "as_of", "flag_min_severity", "disabled_rules", "info_only_rules")}
        text = json.dumps(plain | {n: s.as_dict() for n, s in self.sections.items()}, sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:16]
