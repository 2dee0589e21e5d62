"""Numeric casts, cleaning and arithmetic.

Missing numbers are NULL everywhere: a NaN compares greater than any number in Spark, so
it is turned into NULL where text becomes a number and never travels further.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from edugauge.functions.text import _col, strip


def round_half_even(c, digits: int = 2) -> Column:
    """Round the scaled double half-to-even (``F.round`` rounds half up)."""
    scale = float(10**digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def gap(a, b, digits: int = 2) -> Column:
    """Rounded difference ``a - b``."""
    return round_half_even(_col(a) - _col(b), digits)


def strict_int(c, type_name: str = "int", name: str | None = None) -> Column:
    """Integer cast that raises on bad text *and* on null."""
    label = name or (c if isinstance(c, str) else "value")
    return F.coalesce(
        _col(c).cast(type_name),
        F.raise_error(F.lit(f"strict integer column {label} holds a null or malformed value")),
    )


def nullable_int(c, type_name: str = "bigint") -> Column:
    """Integer cast that lets null through and raises on bad text (ANSI cast)."""
    return _col(c).cast(type_name)


#: Decimal numbers and the named infinities; the JVM parser alone would take type letters and hexadecimal numbers too.
_NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def tolerant_double(c) -> Column:
    """Text to double; whatever is not a decimal number or a named infinity becomes NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def tolerant_int(c) -> Column:
    """Text to bigint: ``"1.0"`` is 1 and ``"x"`` is NULL; a number that is no integer raises."""
    number = tolerant_double(c)
    return F.when(
        number.isNotNull() & (F.abs(number) < F.lit(2.0**63)) & (F.rint(number) == number), number.cast("bigint")
    ).when(number.isNotNull(), F.raise_error(F.concat(F.lit("not an integer: "), number.cast("string"))).cast("bigint"))


def sheet_int(c, name: str | None = None) -> Column:
    """Strict integer from a sheet export, where note rows turn codes into decimals such as ``12.0``."""
    label = name or (c if isinstance(c, str) else "value")
    whole = F.regexp_replace(_col(c).cast("string"), r"^\s*([+-]?\d+)\.0*\s*$", "$1")
    return strict_int(whole, name=label)


def clean_goal(c) -> Column:
    """Goal cell to double: ``-`` and blank are missing, ``> 80`` is 80."""
    text = F.nullif(strip(_col(c).cast("string")), F.lit("-"))
    return tolerant_double(F.replace(text, F.lit(">"), F.lit("")))


def safe_ratio(numerator, denominator) -> Column:
    """Ratio that is 0 where the denominator is 0."""
    den = _col(denominator)
    return F.when(den == 0, F.lit(0.0)).otherwise(_col(numerator) / F.nullif(den, F.lit(0)))


def share_of_parts(part, parts: Sequence) -> Column:
    """Percentage of ``part`` in the sum of ``parts``; NULL where that sum is 0."""
    total = reduce(lambda a, b: a + b, [_col(p) for p in parts])
    return _col(part) / F.nullif(total, F.lit(0)) * F.lit(100.0)


def count_present(cols: Sequence) -> Column:
    """How many of ``cols`` are not null, per row."""
    return reduce(lambda a, b: a + b, [_col(c).isNotNull().cast("int") for c in cols])


def present_flag(*cols) -> Column:
    """1 when at least one of ``cols`` is not null."""
    return (count_present(cols) > 0).cast("int")
