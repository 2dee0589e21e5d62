"""Ordered operators: latest row, first row, change, share of total, running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edugauge.functions.numeric import round_half_even
from edugauge.session import cut_lineage

#: Rows of a range of running totals, about, and ranges that share an offset of their own.
RANGE_ROWS = 1 << 17
RANGE_FANOUT = 1024
#: Ranges whose offsets are broadcast at most.
BROADCAST_RANGES = 1 << 16


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Row with the greatest ``order`` per key; ties go to the greatest remaining columns.

    An aggregate of structs instead of ``row_number``: rows are reduced before the shuffle and
    no task ever sorts a whole group. With no keys the result is the one latest row.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    best = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return best.filter(F.col("_row").isNotNull()).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row per key in an explicit order (``dropDuplicates`` keeps an arbitrary one)."""
    rest = [c for c in df.columns if c not in keys and c != order]
    first = df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def change_vs_previous(
    df: DataFrame, keys: Sequence[str], order: str, measures: Mapping[str, str], digits: int = 2
) -> DataFrame:
    """Rounded difference with the previous row of the key, by position.

    ``measures`` maps new column -> measured column. Expects one row per key and order value
    (the layer checks that key), so a group is as long as the number of years.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns(
        {
            new: round_half_even(F.col(c) - F.lag(c).over(w), digits)
            for new, c in measures.items()
        }
    )


def trend_label(change) -> Column:
    """Melhorou / Piorou / Estável by the sign of a change; NULL stays NULL."""
    value = F.col(change) if isinstance(change, str) else change
    return F.when(value > 0, "Melhorou").when(value < 0, "Piorou").when(value == 0, "Estável")


def share_of_total(df: DataFrame, count: str, share: str) -> DataFrame:
    """Add each row's part of the column total.

    The total is a scalar subquery, so a long table of counts is not pulled into one task as
    an unpartitioned window would do.
    """
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(share, F.col(count) / F.nullif(total, F.lit(0)))


def running_totals(
    df: DataFrame,
    order: str,
    totals: Mapping[str, str],
    by: str | None = None,
    descending: bool = False,
    range_rows: int = RANGE_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Running sums (inclusive) over a table with distinct ``order`` values per ``by`` group.

    ``totals`` maps new column -> summed column. A plain ordered window would sort all rows of a group in one task. Here rows are
    dealt into ranges of about ``range_rows`` rows by ``by`` and ``order``, as many as the counted rows ask for, and stored with the
    number of their range. Ranges are summed, and sums of ``RANGE_FANOUT`` ranges are summed again: a range's offset is the sums of
    the groups of ranges before its own and of the ranges before it in its group. The window runs inside a range only.

    Neither the number of ranges nor that of ``by`` values is limited, and no cut reaches the driver or the plan. The table is
    stored before it is dealt (unless it is ``stored`` already), because ranges are drawn from a sample of it. Where they
    fall affects balance, never the result.
    """
    df = df if stored else cut_lineage(df)
    keys = [by] if by else []
    direction = F.desc if descending else F.asc
    parts = max(1, -(-df.count() // range_rows))
    axis = [*map(F.asc, keys), direction(order)]
    dealt = df.repartitionByRange(parts, *axis) if parts > 1 else df.coalesce(1)
    placed = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()))

    sums = {new: f"_sum_{i}" for i, new in enumerate(totals)}
    ranges = placed.groupBy(*keys, "_range").agg(*[F.sum(c).alias(sums[new]) for new, c in totals.items()])
    ranges = ranges.withColumn("_group", F.floor(F.col("_range") / RANGE_FANOUT))
    groups = ranges.groupBy(*keys, "_group").agg(*[F.sum(s).alias(s) for s in sums.values()])

    def before(table: DataFrame, within: Sequence[str], at: str, name: str) -> DataFrame:
        """Per row of ``table`` the sums of the rows before it in its group."""
        rows = Window.partitionBy(*within).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        earlier = [F.coalesce(F.sum(s).over(rows), F.lit(0)).alias(f"{s}{name}") for s in sums.values()]
        return table.select(*[F.col(c).alias(f"{name}_{c}") for c in (*within, at)], *earlier)

    in_group = before(ranges, [*keys, "_group"], "_range", "_off")
    of_group = before(groups, keys, "_group", "_up")
    met = [F.col(f"_off_{c}").eqNullSafe(F.col(f"_up_{c}")) for c in (*keys, "_group")]
    offsets = in_group.join(of_group, met).select(
        *[f"_off_{c}" for c in (*keys, "_range")], *[(F.col(f"{s}_off") + F.col(f"{s}_up")).alias(s) for s in sums.values()]
    )
    if parts <= BROADCAST_RANGES and not keys:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*keys, "_range").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(offsets, [F.col(c).eqNullSafe(F.col(f"_off_{c}")) for c in (*keys, "_range")])
        .withColumns({new: F.sum(c).over(inside) + F.col(sums[new]) for new, c in totals.items()})
        .drop("_range", *[f"_off_{c}" for c in (*keys, "_range")], *sums.values())
    )
