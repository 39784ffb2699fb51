"""Numeric expressions with float semantics that hold under ANSI mode."""

from __future__ import annotations


def zero_if_null(value: str) -> str:
    return f"coalesce({value}, 0)"


def one_if_zero(value: str) -> str:
    return f"if({value} = 0, 1, {value})"


def float_divide(x: str, y: str) -> str:
    """IEEE division of doubles, where ANSI mode would raise: x/0 is a signed infinity and 0/0 is NaN."""
    return f"if({y} = 0, {x} * double('Infinity'), {x} / {y})"


def percent_change(current: str, previous: str) -> str:
    """Change against `previous` in percent; null when either side is null."""
    return f"100 * {float_divide(f'({current} - {previous})', previous)}"


def clamp(value: str, low: float | None = None, high: float | None = None) -> str:
    """Limit to [low, high]. Null and NaN pass through, which bare `greatest`/`least` would not do."""
    below = "" if low is None else f"WHEN {value} < {low!r}D THEN {low!r}D "
    above = "" if high is None else f"WHEN {value} > {high!r}D AND NOT isnan({value}) THEN {high!r}D "
    return f"CASE {below}{above}ELSE {value} END"


def sum_or_zero(value: str) -> str:
    """Sum of a group, 0 for an all-null group. Sums of decimals are exact and so do not depend on the order in
    which tasks finish; sums of doubles do, in their last digits."""
    return f"coalesce(sum({value}), 0)"
