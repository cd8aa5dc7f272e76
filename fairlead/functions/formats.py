"""Brazilian-Portuguese number texts as SQL expressions."""

from __future__ import annotations

# Text shown in place of a missing number (fixed value).
MISSING = "—"


def usd_billions(value: str) -> str:
    return _or_missing(f"concat({_grouped(f'({value}) / 1e9D', 2)}, ' bi US$')")


def usd_millions(value: str) -> str:
    return _or_missing(f"concat({_grouped(f'({value}) / 1e6D', 2)}, ' mi US$')")


def percentage(fraction: str, decimals: int = 1) -> str:
    """A fraction as ``12,3%``; without a thousands mark."""
    number = f"format_number(({fraction}) * 100D, {int(decimals)})"
    return _or_missing(f"concat(translate({number}, '.,', ','), '%')")


def whole_number(value: str) -> str:
    return f"translate(format_number({value}, 0), ',', '.')"


def _grouped(number: str, decimals: int) -> str:
    """``1234.5`` as ``1.234,50``."""
    return f"translate(format_number({number}, {decimals}), ',.', '.,')"


def _or_missing(text: str) -> str:
    return f"coalesce({text}, '{MISSING}')"
