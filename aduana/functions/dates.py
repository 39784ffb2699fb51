"""Calendar parts of a zone-free timestamp."""

from __future__ import annotations

FISCAL_START_MONTH = 7


def fiscal_year(date: str) -> str:
    """Fiscal year, named after the calendar year it ends in; it starts in July."""
    return f"year({date}) + if(month({date}) >= {FISCAL_START_MONTH}, 1, 0)"


def calendar_parts(date: str) -> dict[str, str]:
    return {
        "qtr": f"quarter({date})",
        "fiscal_year": fiscal_year(date),
        "month": f"month({date})",
        "year": f"year({date})",
    }


def month_start(year: str, month: str) -> str:
    return f"make_timestamp_ntz({year}, {month}, 1, 0, 0, 0)"


def quarter_start(year: str, quarter: str) -> str:
    return month_start(year, f"{quarter} * 3 - 2")


def ntz(text: str) -> str:
    """Zone-free timestamp literal; a comparison of an NTZ column with it is pushed to the scan."""
    return f"TIMESTAMP_NTZ '{text}'"
