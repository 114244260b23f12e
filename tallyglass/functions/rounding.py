"""Rounding that agrees digit for digit with what report readers compute.

Spark's ``round`` and ``bround`` work on the shortest decimal text of a double.
Percentages and scores are expected to be rounded from the binary value
instead, half to even, and means by scaling first.
"""

from __future__ import annotations


def round_scaled(value: str, digits: int) -> str:
    """Scale, round half to even, scale back (the data-frame library rule)."""
    scale = f"{10**digits}D"
    return f"rint({value} * {scale}) / {scale}"


def round_exact(value: str, digits: int) -> str:
    """Correctly rounded from the binary value, half to even.

    ``format_number`` is the one built-in that rounds the binary value.
    """
    return f"CAST(replace(format_number({value}, {digits}), ',', '') AS DOUBLE)"


def percentage(part: str, total: str) -> str:
    """Share of the total in percent, 2 digits; 0 for an empty total."""
    share = round_exact(f"{part} / {total} * 100D", 2)
    return f"CASE WHEN {total} > 0 THEN {share} ELSE 0D END"
