"""Window sizes and delays."""

from __future__ import annotations

# Milliseconds per unit.
UNIT_MILLIS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
    "week": 604_800_000,
}


def millis(duration: int | str) -> int:
    """Milliseconds of ``"10 minutes"``-like text; an int already is in milliseconds."""
    if isinstance(duration, int):
        value = duration
    else:
        parts = duration.split()
        unit = parts[1].lower().removesuffix("s") if len(parts) == 2 else ""
        if unit not in UNIT_MILLIS:
            raise ValueError(f"not a duration: {duration!r}")
        value = int(parts[0]) * UNIT_MILLIS[unit]
    if value < 0:
        raise ValueError(f"negative duration: {duration!r}")
    return value


def interval(duration: int | str) -> str:
    """The duration in the form ``F.window`` and ``withWatermark`` take."""
    return f"{millis(duration)} milliseconds"
