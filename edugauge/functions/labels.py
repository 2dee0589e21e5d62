"""Lookups, bands, flags and year-driven column picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from edugauge.functions.text import _col


def lookup(mapping: Mapping, c, fallback: Column | None = None) -> Column:
    """Dictionary lookup without a join; unmatched keys give NULL or ``fallback``."""
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    value = F.try_element_at(literal_map, _col(c))
    return value if fallback is None else F.coalesce(value, fallback)


def right_closed_band(c, upper_edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Label of the interval ``(a, b]`` that holds the value; the last one is open above."""
    if len(labels) != len(upper_edges) + 1:
        raise ValueError("one more label than edges is needed")
    value = _col(c)
    band = F.when(value.isNull(), F.lit(null_label).cast("string"))
    for edge, label in zip(upper_edges, labels):
        band = band.when(value <= F.lit(float(edge)), label)
    return band.otherwise(labels[-1])


def descending_label(c, thresholds: Sequence[tuple[float, str]], default: str, null_label: str | None) -> Column:
    """First label whose threshold the value reaches, walking thresholds downwards."""
    value = _col(c)
    out = F.when(value.isNull(), F.lit(null_label).cast("string"))
    for cut, label in thresholds:
        out = out.when(value >= F.lit(float(cut)), label)
    return out.otherwise(default)


def yes_no(condition: Column, yes: str = "Sim", no: str = "Não") -> Column:
    """Text flag; a NULL condition counts as *no*."""
    return F.when(condition, yes).otherwise(no)


def flag01(condition: Column) -> Column:
    """0/1 flag; a NULL condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def pick_by_year(year, columns_by_year: Mapping[int, object]) -> Column:
    """Value of the column that belongs to the row's own year; NULL for other years.

    A projection over columns that are already on the row: no unpivot and no second join.
    """
    picked = F.lit(None).cast("double")
    y = _col(year)
    for value_year, c in columns_by_year.items():
        picked = F.when(y == value_year, _col(c)).otherwise(picked)
    return picked
