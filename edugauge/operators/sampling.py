"""Seeded samples, stratified splits and folds.

A split ranks rows by a hash of their key within a class. Ranking itself would sort a whole
class in one task, so only the *cut points* of the ranking are computed: rows are counted per
hash prefix, the prefix that holds a cut is located from those counts, and only the rows of
that prefix are ranked. Every row is then compared with the cuts in a plain projection, exact
to the row and without moving the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_PREFIX = 4


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """Sortable text: hash of key and seed first, the key itself as the tie-break."""
    joined = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.concat_ws("|", F.md5(F.concat_ws("|", joined, F.lit(str(seed)))), joined)


def _class(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("\u0000null"))


def _hash_cuts(df: DataFrame, strata: str, keys: Sequence[str], seed: int, ranks) -> DataFrame:
    """Per class the hash values at the wanted ranks, as an ascending array ``cuts``.

    ``ranks`` maps the class size column to an array of 1-based ranks; ranks of 0 are ignored.
    """
    hashed = df.select(_class(strata).alias("_class"), hash_order(keys, seed).alias("_hash"))
    prefix = F.substring("_hash", 1, HASH_PREFIX)
    # At most 16**HASH_PREFIX rows per class, whatever the size of the table.
    counts = hashed.groupBy("_class", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    sized = counts.withColumns(
        {"_upto": F.sum("_n").over(upto), "_size": F.sum("_n").over(Window.partitionBy("_class"))}
    )
    located = (
        sized.withColumn("_rank", F.explode(ranks(F.col("_size"))))
        .filter((F.col("_rank") > F.col("_upto") - F.col("_n")) & (F.col("_rank") <= F.col("_upto")))
        .select(
            F.col("_class").alias("_c"),
            F.col("_prefix").alias("_p"),
            (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_within"),
        )
    )
    # One row per class and cut: a bounded broadcast.
    wanted = located.groupBy("_c", "_p").agg(F.collect_set("_within").alias("_within"))
    inside = (
        hashed.withColumn("_prefix", prefix)
        .join(F.broadcast(wanted), (F.col("_class") == F.col("_c")) & (F.col("_prefix") == F.col("_p")))
        .withColumn("_pos", F.row_number().over(Window.partitionBy("_class", "_prefix").orderBy("_hash")))
        .filter(F.array_contains("_within", F.col("_pos").cast("bigint")))
    )
    return inside.groupBy("_class").agg(F.array_sort(F.collect_list("_hash")).alias("_cuts"))


def _with_cuts(df: DataFrame, strata: str, cuts: DataFrame) -> DataFrame:
    return df.join(F.broadcast(cuts), _class(strata) == F.col("_class"), "left")


def stratified_part(
    df: DataFrame,
    strata: str,
    keys: Sequence[str],
    fraction: float | None = None,
    rows: int | None = None,
    seed: int = 42,
    column: str = "in_part",
) -> DataFrame:
    """Flag a seeded part of every class: ``round(fraction * class size)`` rows, or ``rows``
    rows in all with the classes in proportion."""
    if (fraction is None) == (rows is None):
        raise ValueError("give either fraction or rows")
    if fraction is not None:
        target = lambda size: F.rint(size * F.lit(float(fraction)))
    else:
        total = df.agg(F.count(F.lit(1))).scalar()
        target = lambda size: F.rint(size * F.least(F.lit(1.0), F.lit(float(rows)) / total))
    cuts = _hash_cuts(df, strata, keys, seed, lambda size: F.array(target(size).cast("bigint")))
    flagged = F.coalesce(hash_order(keys, seed) <= F.element_at("_cuts", -1), F.lit(False))
    return _with_cuts(df, strata, cuts).withColumn(column, flagged).drop("_class", "_cuts")


def stratified_split(
    df: DataFrame, strata: str, keys: Sequence[str], test_fraction: float = 0.30, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with equal class shares on both sides."""
    flagged = stratified_part(df, strata, keys, fraction=test_fraction, seed=seed, column="_test")
    return flagged.filter(~F.col("_test")).drop("_test"), flagged.filter(F.col("_test")).drop("_test")


def stratified_sample(df: DataFrame, strata: str, keys: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    """About ``rows`` rows with the class shares of the table (exact to rounding per class)."""
    return stratified_part(df, strata, keys, rows=rows, seed=seed, column="_kept").filter("_kept").drop("_kept")


def stratified_folds(
    df: DataFrame, strata: str, keys: Sequence[str], folds: int, seed: int = 42, column: str = "fold"
) -> DataFrame:
    """Fold number 0..folds-1; per class the fold sizes differ by one row at most."""

    def bounds(size: Column) -> Column:
        return F.array(
            *[
                (F.floor(size / folds) * i + F.least(F.lit(i), size % folds)).cast("bigint")
                for i in range(1, folds)
            ]
        )

    cuts = _hash_cuts(df, strata, keys, seed, bounds)
    own = hash_order(keys, seed)
    # A class smaller than the number of folds has fewer distinct cuts; the rest stays empty.
    fold = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < own)), F.lit(0))
    return _with_cuts(df, strata, cuts).withColumn(column, fold.cast("int")).drop("_class", "_cuts")


def temporal_split(df: DataFrame, year: str, train_year: int, test_year: int) -> tuple[DataFrame, DataFrame]:
    """Train on one year, test on a later one."""
    return df.filter(F.col(year) == train_year), df.filter(F.col(year) == test_year)


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (fewer if the table is shorter), the same ones on every cluster."""
    return df.orderBy(hash_order(keys, seed)).limit(n)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """First ``k`` rows by a column, nulls last, ties broken by ``ties``."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(first, *[F.asc(t) for t in ties]).limit(k)
