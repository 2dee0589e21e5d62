"""Aggregates over a long attribution table ``(row_id, feature, phi)``.

Features are named ``number`` or ``column=value`` for a category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def importance_by_feature(phi: DataFrame, n_rows: DataFrame | None = None) -> DataFrame:
    """Mean absolute attribution per expanded feature, greatest first.

    A long table may leave out zero entries; give ``n_rows`` (one row, one count) then, so that
    the mean is over all explained rows.
    """
    total = F.sum(F.abs("phi"))
    if n_rows is None:
        mean = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))
    else:
        mean = phi.groupBy("feature").agg((total / n_rows.scalar()).alias("importance"))
    return mean.orderBy(F.desc("importance"), "feature")


def importance_by_variable(importance: DataFrame) -> DataFrame:
    """Sum the expanded features back to their variable (the text before ``=``)."""
    variable = F.split("feature", "=", 2)[0]
    return (
        importance.groupBy(variable.alias("variable"))
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "variable")
    )


def effect_by_category(phi: DataFrame, rows: DataFrame, row_id: str, column: str) -> DataFrame:
    """Signed mean attribution of each category over the rows that have it.

    ``phi`` is restricted to the column's own features before the join; categories that were
    unknown when the model was fitted have no such feature and drop out.
    """
    own = phi.filter(F.col("feature").startswith(f"{column}=")).select(
        F.col("row_id").alias("_row"), F.col("feature").alias("_feature"), "phi"
    )
    tagged = rows.select(F.col(row_id).alias("_id"), F.col(column).cast("string").alias("category"))
    match = (F.col("_row") == F.col("_id")) & (F.col("_feature") == F.concat(F.lit(f"{column}="), F.col("category")))
    return (
        own.join(tagged, match)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("phi").alias("mean_phi"))
        .orderBy("mean_phi", "category")
    )
