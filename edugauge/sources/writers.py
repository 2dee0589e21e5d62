"""Sinks: layer tables, reports and size-bounded CSV shards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.sources.readers import YEARLY_ENCODING, YEARLY_SEPARATOR


def write_table(df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Full overwrite of a layer table. The pupil tables are partitioned by year, so that one
    year is read by partition pruning. Rows stay in the partitions they are in: a repartition
    by year would put a whole year, a third of all rows, into one task.
    """
    path = f"{layer}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """Small report as one CSV file. Meant for aggregated tables of bounded size."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def shard_row_limit(df: DataFrame, max_bytes: int, separator: str = YEARLY_SEPARATOR) -> int:
    """Rows per shard that keep every shard, header included, within ``max_bytes``.

    One aggregate over the formatted lines gives the widest row; a shard of that many widest
    rows is still within the bound.
    """
    line = F.to_csv(F.struct(*[F.col(c).cast("string") for c in df.columns]), {"sep": separator})
    widest = df.agg(F.max(F.octet_length(line)).alias("n")).first()["n"] or 1
    header = len(separator.join(df.columns).encode("utf-8")) + 1
    return max(1, (max_bytes - header) // (int(widest) + 1))


def write_sharded(
    df: DataFrame,
    path: str,
    max_rows: int | None = None,
    max_bytes: int | None = None,
    separator: str = YEARLY_SEPARATOR,
    encoding: str = YEARLY_ENCODING,
) -> str:
    """CSV shards of bounded size, each with its own header. The input is left alone."""
    if (max_rows is None) == (max_bytes is None):
        raise ValueError("give either max_rows or max_bytes")
    limit = max_rows if max_rows is not None else shard_row_limit(df, max_bytes, separator)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("maxRecordsPerFile", limit)
        .csv(path)
    )
    return path


def stamp(df: DataFrame, processed_at: datetime | Column | None = None) -> DataFrame:
    """Processing date and time; pass ``processed_at`` for reproducible output."""
    if processed_at is None:
        moment = F.current_timestamp()
    else:
        moment = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
    return df.withColumns({"DT_PROCESSAMENTO": F.to_date(moment), "TS_PROCESSAMENTO": moment.cast("timestamp")})


def stored_counts(stored: DataFrame, target: str | None = None) -> dict[str, int]:
    """Row count, and the target values, of a stored table for the run log.

    On Parquet the rows come from the file footers and the targets from one column. The
    ``observe`` API would count during the write, but a session that has used it can no longer
    ship MLlib models whose training summary holds the session, so it is not used here.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if target:
        metrics += [
            F.count_if(F.col(target) == 1).alias("target_1"),
            F.count_if(F.col(target) == 0).alias("target_0"),
            F.count_if(F.col(target).isNull()).alias("target_null"),
        ]
    return stored.agg(*metrics).first().asDict()
