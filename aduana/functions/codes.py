"""Classification codes: prefixes and fixed-width forms."""

from __future__ import annotations


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def code_prefix(code: str, digits: int) -> str:
    return f"substring({code}, 1, {digits})"


def code_text(code: str, width: int | None = None) -> str:
    """Code as text. A numeric code has lost its leading zeros; `width` puts them back."""
    text = f"string({code})"
    return text if width is None else f"if(length({text}) < {width}, lpad({text}, {width}, '0'), {text})"


def starts_with(code: str, prefix: str) -> str:
    """Prefix test. Every non-null code has the empty prefix, and IS NOT NULL is the cheaper filter."""
    return f"startswith({code}, {text_literal(prefix)})" if prefix else f"{code} IS NOT NULL"
