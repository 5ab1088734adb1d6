"""Durations written as text (``"5 seconds"``) in microseconds."""

from __future__ import annotations

# Microseconds per unit.
UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """``"1 hour 30 minutes"`` to 5_400_000_000."""
    words = duration.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    return sum(int(n) * UNITS[unit.removesuffix("s")] for n, unit in zip(words[::2], words[1::2]))
