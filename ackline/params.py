"""Operator parameters: defaults and range checks."""

from __future__ import annotations

from collections.abc import Sequence

# Defaults and limits of the record and object contract.
RECORD_OVERHEAD_BYTES = 128
MAX_PAYLOAD_BYTES = 1024 * 1024
MEMORY_BUDGET_BYTES = 64 * 1024 * 1024
WORK_QUEUE_CAPACITY = 2048
PAUSE_HIGH_PERCENT = 80
RESUME_LOW_PERCENT = 50
MAX_OBJECT_SIZE = 1024 * 1024 * 1024
WORKER_COUNT = 8
STREAM_IDLE_TIMEOUT_MS = 20_000
COMMIT_INTERVAL_MS = 5_000
U32_MAX = 2**32 - 1
I64_MAX = 2**63 - 1
U64_MAX = 2**64 - 1


def positive(name: str, value: int, maximum: int | None = None) -> int:
    """Return ``value`` if it is an integer in ``1..maximum``."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError(f"{name} must be an integer")
    if value < 1 or (maximum is not None and value > maximum):
        upper = "" if maximum is None else f" and at most {maximum}"
        raise ValueError(f"{name} must be greater than zero{upper}")
    return value


def budgets(max_payload_bytes: int, memory_budget_bytes: int) -> tuple[int, int]:
    """Check the payload limit against the memory budget that must hold it."""
    positive("memory_budget_bytes", memory_budget_bytes, U32_MAX)
    positive("max_payload_bytes", max_payload_bytes, memory_budget_bytes)
    return max_payload_bytes, memory_budget_bytes


def watermarks(pause_high_percent: int, resume_low_percent: int) -> tuple[int, int]:
    """Check ``0 < low < high <= 100``."""
    positive("pause_high_percent", pause_high_percent, 100)
    positive("resume_low_percent", resume_low_percent, 100)
    if resume_low_percent >= pause_high_percent:
        raise ValueError("resume_low_percent must be below pause_high_percent")
    return pause_high_percent, resume_low_percent


def names(name: str, values: Sequence[str]) -> list[str]:
    """Check a non-empty list without blank elements."""
    checked = list(values)
    if isinstance(values, str) or not checked or any(not v.strip() for v in checked):
        raise ValueError(f"{name} must contain at least one non-empty value")
    return checked


def choice(name: str, value: str, allowed: Sequence[str]) -> str:
    """Return ``value`` if it is one of ``allowed``."""
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")
    return value
