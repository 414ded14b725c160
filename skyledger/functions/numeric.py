"""Rounding and division rules.

Three kinds of rounding are in use and none may be swapped for another:

* fact measures: exact decimal seconds, rounded half away from zero on load;
* warehouse KPIs: IEEE doubles, rounded as ``round(x * 10^n) / 10^n``;
* raw-table KPIs: exact ratios of integers, rounded half away from zero.

A division by zero yields NULL. The KPI rules take and return SQL text, so that
a long formula is one expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_units(seconds: Column, seconds_per_unit: int, digits: int = 2) -> Column:
    """Exact seconds to hours or days, rounded half away from zero.

    The quotient keeps at least 11 decimals; the nearest value to a rounding
    tie is one microsecond away (1e-11 days), so rounding twice is safe.
    """
    return F.round(seconds / F.lit(seconds_per_unit), digits)


def double_ratio(num: str, den: str) -> str:
    """IEEE division of any two numbers."""
    return f"try_divide(cast({num} as double), cast({den} as double))"


def round_double(x: str, digits: int) -> str:
    """Round the binary value of a double, halves away from zero.

    Spark's ``round`` rounds the printed decimal instead (``1.005`` -> 1.01).
    From 2^52 on a double holds no fraction, and ``floor`` would leave BIGINT.
    """
    scale = f"{10**digits}.0D"
    y = f"(abs({x}) * {scale})"
    whole = f"(floor({y}) + if({y} - floor({y}) >= 0.5D, 1, 0))"
    return f"case when {y} < {float(2**52)}D then signum({x}) * {whole} / {scale} else {x} end"


def rounded_units(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half away from zero, as a count of ``10^-digits``.

    ``num`` and ``den`` hold integers and the arithmetic is exact. What is left
    without the remainder divides evenly; ``div`` is no way out, as it wraps
    around beyond BIGINT without an error.
    """
    integer = lambda x: f"cast({x} as decimal(38,0))"
    n, d = integer(num), integer(den)
    signed = f"if({d} < 0, -{n}, {n})"
    half = f"if({signed} < 0, -abs({d}), abs({d}))"
    dividend = integer(f"{signed} * {2 * 10**digits} + {half}")
    divisor = f"nullif({integer(f'abs({d}) * 2')}, 0)"
    return integer(f"({dividend} - {dividend} % {divisor}) / {divisor}")


def from_units(units: str, digits: int) -> str:
    """A count of ``10^-digits`` as a double."""
    return f"cast({units} as double) / {10**digits}.0D"


def micros(name: str) -> str:
    """The summed parts of a duration as a whole number of microseconds."""
    return f"(cast({name}_sec as decimal(25,0)) * 1000000 + {name}_us)"
