"""tape_audit: a Spark-first audit engine for header-plus-detail ledgers such as loan tapes."""

from tape_audit.config import PolicyError, Policy

__all__ = ["PolicyError", "Policy"]
