"""Time as text."""

from __future__ import annotations

from tallyglass.fixed_values import READABLE_FORMAT

# ISO date and time with microseconds, in the session time zone.
NOW = "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"


def readable_timestamp(epoch: str, fmt: str = READABLE_FORMAT) -> str:
    """Formatted in the session time zone (UTC once ``session.prepare`` ran)."""
    return f"from_unixtime({epoch}, '{fmt}')"
