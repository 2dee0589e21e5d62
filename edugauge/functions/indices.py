"""Proficiency-level profiles and indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from edugauge.functions.numeric import round_half_even
from edugauge.functions.text import _col

# Profile -> the two levels it adds. The borderline profile takes level 1
# a second time; results have to reproduce that.
PROFILE_LEVELS = {
    "PC_PERFIL_EXTREMA_DEFASAGEM": (0, 1),
    "PC_PERFIL_EM_DESENVOLVIMENTO": (2, 3),
    "PC_PERFIL_LIMITROFE": (4, 1),
    "PC_PERFIL_AVANCADO": (5, 6),
    "PC_TAXA_EXCELENCIA": (7, 8),
}

# Weights of levels 0..3 in the structural risk index, and its divisor.
RISK_WEIGHTS = (4, 3, 2, 1)
RISK_DIVISOR = 400.0


def level_profiles(levels: Sequence) -> dict[str, Column]:
    """The five rounded profile percentages from the nine level shares."""
    cols = [_col(c) for c in levels]
    return {name: round_half_even(cols[a] + cols[b]) for name, (a, b) in PROFILE_LEVELS.items()}


def polarisation_index(excellence, extreme_lag) -> Column:
    """Excellence over extreme lag, guarded against an empty low profile."""
    return round_half_even(_col(excellence) / (_col(extreme_lag) + F.lit(0.01)))


def structural_risk_index(levels: Sequence, low_profile, developing_profile) -> Column:
    """Weighted share of levels 0..3 on a 0..1 scale; 0 when both low profiles are empty."""
    weighted = sum((_col(c) * w for c, w in zip(levels, RISK_WEIGHTS)), F.lit(0.0))
    return F.when(_col(low_profile) + _col(developing_profile) == 0, F.lit(0.0)).otherwise(
        round_half_even(weighted / F.lit(RISK_DIVISOR), 4)
    )
