"""Numbers as text, printed the way Python's format mini-language prints them.

``format_number`` (``java.text.DecimalFormat``) rounds the exact binary value
of a double, half to even only on exact ties, as Python and C ``printf`` do.
``format_string('%.2f')`` (``java.util.Formatter``) instead rounds the
shortest decimal string half up: 74375.045 is stored as 74375.04499999...,
which Python prints as 74375.04 and ``format_string`` as 74375.05.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c: str | Column, digits: int) -> Column:
    """``c`` with ``digits`` decimals and no grouping, like ``f"{x:.2f}"``.

    NaN and NULL print as ``nan`` (a missing value reaches a pandas report
    as NaN), infinities as ``inf`` / ``-inf``.

    Equal to Python's text whenever ``|x| * 10**digits`` is below about
    2**53 (9e15); checked on random values up to 1e12 with 2 decimals and
    up to 1e17 with none. For larger values the shortest decimal form of a
    double can be shorter than the digits asked for: ``format_number`` pads
    it with zeros where Python prints the binary value's exact digits.
    """
    if digits < 0:
        raise ValueError("digits must be >= 0")
    x = _col(c)
    as_double = x.cast("double")
    return (
        F.when(x.isNull() | F.isnan(as_double), F.lit("nan"))
        .when(as_double == F.lit(float("inf")), F.lit("inf"))
        .when(as_double == F.lit(float("-inf")), F.lit("-inf"))
        .otherwise(F.regexp_replace(F.format_number(x, digits), ",", ""))
    )


def grouped(c: str | Column) -> Column:
    """A whole number with thousands separators, like ``f"{n:,}"``."""
    return F.format_number(_col(c), 0)
