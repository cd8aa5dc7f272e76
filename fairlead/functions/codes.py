"""Typing of codes, months and money."""

from __future__ import annotations

from fairlead.schemas import CODE_WIDTHS


# Year of a raw trade row.
YEAR = "int(CO_ANO)"


def text(raw: str, name: str) -> str:
    return f"string({raw}) AS {name}"


def code(raw: str, name: str) -> str:
    """Fixed-width code from a string or numeric column; padding twice changes nothing."""
    return f"lpad(string({raw}), {CODE_WIDTHS[name]}, '0') AS {name}"


def whole(raw: str, name: str) -> str:
    return f"bigint({raw}) AS {name}"


def money(raw: str, name: str) -> str:
    return f"double({raw}) AS {name}"


def month_start(year: str, month: str, name: str) -> str:
    """First day of a month; NULL where ``month`` is none, which the tests of the models report."""
    known = f"try_cast({month} AS INT) BETWEEN 1 AND 12"
    return f"CASE WHEN {known} THEN make_date(int({year}), int({month}), 1) END AS {name}"


def cif(fob: str, charges: tuple[str, ...], name: str) -> str:
    """FOB plus the charges, where a missing charge costs nothing.

    A missing FOB is not filled in: its CIF is NULL.
    """
    terms = [f"double({fob})"] + [f"ifnull(double({charge}), 0D)" for charge in charges]
    return f"{' + '.join(terms)} AS {name}"


def share(part: str, whole_sum: str) -> str:
    """``part / whole``, NULL when the whole is zero."""
    return f"({part}) / nullif({whole_sum}, 0D)"
