"""Scans. Text files are read as strings only: every cast is an explicit later step."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_ORDER = "_ingest_order"

# Format of the yearly files.
YEARLY_SEPARATOR = ";"
YEARLY_ENCODING = "ISO-8859-1"


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    separator: str = YEARLY_SEPARATOR,
    encoding: str = YEARLY_ENCODING,
    ingest_order: bool = False,
) -> DataFrame:
    """Delimited file with a header row, all columns as strings.

    ``columns`` keeps the wanted columns that the header really has. ``ingest_order`` adds the
    position of the row (file, byte block, row within the block), which is what "first row
    wins" has to be based on once the scan is split over many tasks.
    """
    df = (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )
    kept = list(df.columns) if columns is None else [c for c in columns if c in df.columns]
    out = [F.col(c) for c in kept]
    if ingest_order:
        out.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(INGEST_ORDER)
        )
    return df.select(*out)


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that one frame lacks is NULL for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_yearly(
    spark: SparkSession,
    base: str,
    file_name: str,
    years: Sequence[int],
    columns: Sequence[str] | None = None,
    ingest_order: bool = False,
    **options,
) -> DataFrame:
    """``<base>/<year>/<file_name>`` for every year that exists, aligned by column name.

    A missing year is skipped; only when no year at all is found the read fails.
    """
    frames = []
    for year in years:
        try:
            frames.append(
                read_delimited(spark, f"{base}/{year}/{file_name}", columns, ingest_order=ingest_order, **options)
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        raise FileNotFoundError(f"no {file_name} under {base}/<year> for years {list(years)}")
    df = union_aligned(frames)
    missing = [c for c in (columns or []) if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


def read_sheet(spark: SparkSession, path: str, key: str, separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV export of a sheet: title in row 1, header in row 2, loose note rows at the end.

    Rows without ``key`` are dropped, which removes the title and the notes. Only the two
    heading rows are looked at on the driver, as any header-driven reader does.
    """
    raw = spark.read.option("header", False).option("sep", separator).option("encoding", encoding).csv(path)
    heading = raw.take(2)
    if len(heading) < 2:
        raise ValueError(f"{path} has no header in its second row")
    names = [name.strip() if name else f"_unnamed_{i}" for i, name in enumerate(heading[1])]
    if key not in names:
        raise ValueError(f"{path} has no column {key}")
    body = raw.toDF(*names)
    title = heading[0][names.index(key)] or ""
    return body.filter(F.col(key).isNotNull() & ~F.col(key).isin(key, title))


def read_csv(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """Plain CSV with a declared schema; columns are matched by header name."""
    strings = spark.read.option("header", True).option("sep", separator).csv(path)
    wanted = spark.createDataFrame([], schema).schema
    return strings.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def read_table(spark: SparkSession, layer: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table of a layer. Column pruning and partition filters reach the scan."""
    df = spark.read.parquet(f"{layer}/{name}")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Even out a scan that has fewer splits than the cluster has cores.

    One Parquet row group is one task however many cores there are. A scan with enough splits,
    which is every large table, is returned unchanged: no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Report written by :func:`edugauge.sources.write_report`."""
    return read_csv(spark, path, schema) if schema else spark.read.option("header", True).csv(path)


def read_sharded(spark: SparkSession, path: str, separator: str = YEARLY_SEPARATOR, encoding: str = YEARLY_ENCODING) -> DataFrame:
    """All shards of a folder as one table; the row set is kept, the row order is not."""
    return read_delimited(spark, path, separator=separator, encoding=encoding)
