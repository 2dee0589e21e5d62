"""Descriptive aggregates. Rows are reduced before any shuffle; nothing sorts a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.functions.numeric import round_half_even
from edugauge.operators.windows import running_totals, share_of_total
from edugauge.session import cut_lineage


def _long(df: DataFrame, cols: Sequence[str], name: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): the explode of a literal array of name/value structs."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in cols])
    return df.select(*keep, F.inline(pairs))


def group_mean(df: DataFrame, keys: Sequence[str], column: str, alias: str | None = None) -> DataFrame:
    """Mean per key; rows with a null key are left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.avg(column).alias(alias or column))


def flag_shares(df: DataFrame, keys: Sequence[str], flags: Mapping[str, str], where: Column) -> DataFrame:
    """Share (0..1) of each 0/1 flag over the rows that satisfy ``where``, per key."""
    kept = df.filter(where).na.drop(subset=list(keys))
    return kept.groupBy(*keys).agg(*[F.avg(c).alias(new) for new, c in flags.items()])


def weighted_rate(df: DataFrame, outcome: str, weight: str, by: Sequence[str] = (), alias: str = "rate") -> DataFrame:
    """``100 * sum(y*w) / sum(w)``. A row without weight is in neither sum, so only assessed
    pupils count. This is the published indicator, not the base rate of a model, which gives
    unassessed pupils the neutral weight 1 (see ``ml.features.model_weight``)."""
    total = F.sum(F.col(weight))
    rate = F.sum(F.col(outcome) * F.col(weight)) / F.nullif(total, F.lit(0)) * 100
    kept = df.na.drop(subset=list(by)) if by else df
    return kept.groupBy(*by).agg(rate.alias(alias))


def value_counts(
    df: DataFrame, cols: Sequence[str], share: str | None = None, dropna: bool = True, count: str = "n"
) -> DataFrame:
    """Rows per value, optionally with the share in the total."""
    kept = df.na.drop(subset=list(cols)) if dropna else df
    counts = kept.groupBy(*cols).agg(F.count(F.lit(1)).alias(count))
    return share_of_total(counts, count, share) if share else counts


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Percentage of nulls per column, one pass over the table whatever its width."""
    names = list(cols or df.columns)
    one = df.agg(*[round_half_even(F.avg(F.col(c).isNull().cast("int")) * 100, digits).alias(c) for c in names])
    return _long(one, names, "column_name", "null_pct")


def coverage(df: DataFrame, cols: Sequence[str], digits: int = 1) -> DataFrame:
    """Percentage of non-null values per column."""
    one = df.agg(*[round_half_even(F.avg(F.col(c).isNotNull().cast("int")) * 100, digits).alias(c) for c in cols])
    return _long(one, list(cols), "column_name", "coverage_pct")


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values per column."""
    one = df.agg(*[F.count_distinct(F.col(c)).cast("bigint").alias(c) for c in cols])
    return _long(one, list(cols), "column_name", "n_distinct")


def rollup_first(
    df: DataFrame, key: str, outcome: str, constants: Sequence[str], size: str = "n_rows", rate: str = "rate"
) -> DataFrame:
    """Size, mean outcome and the per-key constants.

    The constants have one value per key, so ``max`` returns it whatever the row order.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias(size),
            F.avg(outcome).alias(rate),
            *[F.max(c).alias(c) for c in constants],
        )
    )


def correlation_vector(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every column with ``target`` in a single aggregate.

    A pair with a null side is skipped for that column only.
    """
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return _long(one, list(cols), "column_name", "corr")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence, percent: bool = False) -> DataFrame:
    """Counts of ``row`` x ``column`` for the given column values; absent cells are 0.

    Conditional counts in one aggregate. With ``percent`` the cells are shares of the row
    total, rounded to three digits and multiplied by 100.
    """
    kept = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    cells = kept.groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).cast("bigint").alias(str(v)) for v in values]
    )
    if not percent:
        return cells
    total = reduce(lambda a, b: a + b, [F.col(str(v)) for v in values])
    return cells.select(
        row, *[(round_half_even(F.col(str(v)) / F.nullif(total, F.lit(0)), 3) * 100).alias(str(v)) for v in values]
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows ``(column_name, p, value)``.

    ``percentile`` gathers every distinct value of a column in one task. Here values are
    counted (partial aggregate), counts get running totals by range, and only the two values
    around each wanted rank are kept.
    """
    values = cut_lineage(
        _long(df.select(*[F.col(c).cast("double") for c in cols]), cols, "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return quantiles_of_counts(values, probabilities)


def quantiles_of_counts(values: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """:func:`exact_quantiles` of a stored table of counted values, ``(column_name, value, _n)``."""
    ranked = running_totals(values, "value", {"_upto": "_n"}, by="column_name", stored=True)
    sizes = values.groupBy("column_name").agg(F.sum("_n").alias("_size"))
    wanted = (
        sizes.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("_rank", F.col("p") * (F.col("_size") - 1))
        .select(
            F.col("column_name").alias("_name"),
            "p",
            F.col("_rank"),
            F.floor("_rank").alias("_low"),
            F.ceil("_rank").alias("_high"),
        )
    )
    # One row per column and probability: a bounded broadcast.
    covers_low = (F.col("_upto") - F.col("_n") <= F.col("_low")) & (F.col("_low") < F.col("_upto"))
    covers_high = (F.col("_upto") - F.col("_n") <= F.col("_high")) & (F.col("_high") < F.col("_upto"))
    hits = ranked.join(F.broadcast(wanted), F.col("column_name") == F.col("_name")).filter(covers_low | covers_high)
    low = F.max(F.when(covers_low, F.col("value")))
    high = F.max(F.when(covers_high, F.col("value")))
    weight = F.max(F.col("_rank") - F.col("_low"))
    return hits.groupBy("column_name", "p").agg((low + (high - low) * weight).alias("value"))


def describe_exact(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column, as rows ``(stat, value)``."""
    value = F.col(column).cast("double")
    names = ["count", "mean", "std", "min", "max"]
    moments = df.agg(
        F.count(value).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75]).select(
        F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"), "value"
    )
    rows = _long(moments, names, "stat", "value").unionByName(quartiles)
    return rows.withColumn("value", round_half_even("value", digits))


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram over the observed range; the maximum falls in the last bin.

    All ``bins`` rows are returned, empty ones with 0. The range is a scalar subquery, so the
    whole is two scans and no driver round trip.
    """
    kept = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"))
    edges = kept.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    bounds = edges.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("b")
    ).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    position = F.floor((F.col("_x") - lo) / (hi - lo) * bins)
    counted = (
        kept.select(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        axis.join(counted, "bin", "left")
        .withColumns({"n": F.coalesce("n", F.lit(0)), "bin_start": lo + (hi - lo) * F.col("bin") / bins})
        .select("bin", "bin_start", "n")
    )


def regression_line(df: DataFrame, x_cols: Sequence[str], y: str) -> DataFrame:
    """Least-squares line of ``y`` on each column: ``(column_name, slope, intercept)``."""
    one = df.agg(
        *[F.struct(F.regr_slope(y, c).alias("slope"), F.regr_intercept(y, c).alias("intercept")).alias(c) for c in x_cols]
    )
    return _long(one, list(x_cols), "column_name", "_line").select("column_name", "_line.slope", "_line.intercept")


def group_profile(df: DataFrame, key: str, cols: Sequence[str], size: str = "n_rows", digits: int = 2) -> DataFrame:
    """Rounded column means and the size of each group."""
    return df.groupBy(key).agg(
        *[round_half_even(F.avg(c), digits).alias(c) for c in cols], F.count(F.lit(1)).alias(size)
    )


def alert_counts(df: DataFrame, alerts: Sequence[str]) -> DataFrame:
    """Number of raised alerts per alert column."""
    one = df.agg(*[F.count_if(F.col(c)).cast("bigint").alias(c) for c in alerts])
    return _long(one, list(alerts), "alert", "n")


def collapse_profiles(df: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """One row per distinct feature combination with row count and summed weight."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    if weight:
        aggregates.append(F.sum(weight).alias(weight))
    return df.groupBy(*features).agg(*aggregates)


def profile_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many distinct feature profiles there are and how many rows share one."""
    return collapse_profiles(df, features).agg(
        F.count(F.lit(1)).alias("n_profiles"),
        F.avg("n_rows").alias("rows_per_profile"),
        F.max("n_rows").alias("largest_profile"),
    )


def zscore(df: DataFrame, cols: Sequence[str], inverted: Sequence[str] = ()) -> DataFrame:
    """Z-score per column with the sample deviation; ``inverted`` columns change sign."""
    stats = df.agg(
        F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).alias("s")
    ).scalar()
    scores = {}
    for c in cols:
        z = (F.col(c) - stats[f"m_{c}"]) / F.nullif(stats[f"s_{c}"], F.lit(0.0))
        scores[c] = -z if c in inverted else z
    return df.withColumns(scores)
