"""Column expressions. Everything here returns a ``Column`` and stays inside the JVM."""

from edugauge.functions.dictionaries import (
    DEPENDENCY_NAMES,
    NETWORK_NAMES,
    STATE_CODES,
    STATE_REGIONS,
)
from edugauge.functions.indices import (
    PROFILE_LEVELS,
    level_profiles,
    polarisation_index,
    structural_risk_index,
)
from edugauge.functions.labels import (
    descending_label,
    flag01,
    lookup,
    pick_by_year,
    right_closed_band,
    yes_no,
)
from edugauge.functions.numeric import (
    clean_goal,
    count_present,
    gap,
    nullable_int,
    present_flag,
    round_half_even,
    safe_ratio,
    share_of_parts,
    strict_int,
    sheet_int,
    tolerant_double,
    tolerant_int,
)
from edugauge.functions.text import (
    concat_key,
    joined_label,
    sha256_key,
    strip,
    title_case,
    zero_padded,
)

__all__ = [
    "DEPENDENCY_NAMES", "NETWORK_NAMES", "STATE_CODES", "STATE_REGIONS",
    "PROFILE_LEVELS", "level_profiles", "polarisation_index", "structural_risk_index",
    "descending_label", "flag01", "lookup", "pick_by_year", "right_closed_band", "yes_no",
    "clean_goal", "count_present", "gap", "nullable_int", "present_flag", "round_half_even",
    "safe_ratio", "share_of_parts", "sheet_int", "strict_int", "tolerant_double", "tolerant_int",
    "concat_key", "joined_label", "sha256_key", "strip", "title_case", "zero_padded",
]
