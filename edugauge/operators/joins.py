"""Equi-joins of facts with small territorial dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 500_000


def guard_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` itself, with a check inside the plan that ``keys`` are unique.

    A left join with such a side cannot multiply rows. Equal keys meet in a partial
    aggregate first, so a heavily repeated key does not overload one task before it fails.
    """
    rest = [c for c in dim.columns if c not in keys]
    grouped = dim.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit(f"join key {list(keys)} is not unique: "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message))
    return grouped.filter(unique).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def broadcast_within(dim: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint, given only after the size has been checked.

    The check reads at most ``max_rows + 1`` rows. A larger side is returned without a hint:
    the join is then a shuffle join whose hot partitions AQE splits.
    """
    if dim.select(F.lit(1)).limit(max_rows + 1).count() > max_rows:
        return dim
    return F.broadcast(dim)


def left_join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    broadcast_rows: int | None = None,
    unique: bool = True,
    keep_right_keys: bool = False,
) -> DataFrame:
    """Left join that keeps the fact's row count.

    ``on`` pairs fact columns with dimension columns. With ``broadcast_rows`` the dimension is
    measured and broadcast when it is within that bound (right for a stored dimension, where
    measuring is a cheap read); without it the optimizer and AQE choose from the sizes they see.
    """
    right_keys = [r for _, r in on]
    side = guard_unique(dim, right_keys) if unique else dim
    if broadcast_rows is not None:
        side = broadcast_within(side, broadcast_rows)
    renamed = {r: f"_right_{r}" for r in right_keys}
    side = side.withColumnsRenamed(renamed)
    condition = [fact[left] == side[renamed[right]] for left, right in on]
    joined = fact.join(side, condition, "left")
    if keep_right_keys:
        fact_columns = set(fact.columns)
        back = {renamed[r]: r for r in right_keys if r not in fact_columns}
        return joined.withColumnsRenamed(back).drop(*[renamed[r] for r in right_keys if r in fact_columns])
    return joined.drop(*renamed.values())


def attach_single_row(df: DataFrame, one_row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Put the only row of ``one_row`` on every row, as a scalar subquery.

    More than one row makes the subquery fail; none at all raises here.
    """
    value = one_row.select(F.struct(*columns).alias("_one")).scalar()
    present = F.coalesce(value, F.raise_error(F.lit("the single-row side is empty")))
    return (
        df.withColumn("_one", present)
        .withColumns({c: F.col(f"_one.{c}") for c in columns})
        .drop("_one")
    )


def calendar_lag(
    df: DataFrame,
    keys: Sequence[str],
    year: str,
    measures: Sequence[str],
    suffix: str = "_ANTERIOR",
) -> DataFrame:
    """Pair each (key, year) with the measures of the calendar year before; others drop out.

    Not a positional ``lag``: after a gap year nothing may be paired. The join key holds the
    year, so one much-observed key does not form a hot group.
    """
    previous = df.select(
        *keys,
        (F.col(year) + 1).alias(year),
        *[F.col(m).alias(f"{m}{suffix}") for m in measures],
    )
    return df.join(previous, [*keys, year], "inner")


def truncated_code_join(df: DataFrame, dim: DataFrame, code: str, short_code: str) -> DataFrame:
    """Left join of a code with check digit to a dimension keyed without it."""
    keyed = df.withColumn("_short_code", F.expr(f"`{code}` div 10"))
    return left_join_dim(keyed, dim, [("_short_code", short_code)]).drop("_short_code")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows without a partner in the dimension; a null key counts as an orphan."""
    key = dim_key or fact_key
    # Distinct keys are a partial aggregate: repeated dimension keys never travel.
    side = dim.select(F.col(key).alias("_dim_key")).distinct()
    return fact.join(side, fact[fact_key] == side["_dim_key"], "left_anti")
