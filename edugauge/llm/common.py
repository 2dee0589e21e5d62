"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.session import scratch_path

#: A stored table is broadcast up to this many bytes (rows times the stated row width); beyond, it is shuffled.
BROADCAST_BYTES = 32 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_shipped: set[str] = set()


def quoted(name: str) -> Column:
    """Column of that very name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` (long) and ``_text`` (null becomes empty); whatever else the table holds is left behind."""
    return docs.select(
        quoted(id_col).cast("long").alias("_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("_text")
    )


def crc_of_id(id_col: str) -> Column:
    """crc32 of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(stored: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a stored table whose counted rows fit ``limit``; else the table as it is (shuffle join)."""
    return F.broadcast(stored) if stored.count() * row_bytes <= limit else stored


def parallelism(spark: SparkSession) -> int:
    """Partitions of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="edugauge-code-")) / "edugauge_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to pieces of few rows, so that a task never holds many long texts as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers first.

    Columns that ``schema`` takes over from ``df`` go by number on the way, so they may have any name.
    """
    ship(df.sparkSession)
    names = {field.name for field in schema.fields}
    numbers = {c: f"c{i}" for i, c in enumerate(df.columns) if c in names}
    numbered = df.toDF(*(numbers.get(c, c) for c in df.columns))
    inner = T.StructType([T.StructField(numbers.get(f.name, f.name), f.dataType) for f in schema.fields])
    return numbered.mapInArrow(function, inner).toDF(*(f.name for f in schema.fields))


def keep_columns(docs: DataFrame, *dropped: str) -> list[Column]:
    """All columns of ``docs`` but those whose names an operator is about to write."""
    gone = {name.lower() for name in dropped}
    return [quoted(name) for name in docs.columns if name.lower() not in gone]


def quantiles(df: DataFrame, column: str, parts: int) -> list[int]:
    """Distinct approximate cuts of a long column into ``parts`` ranges; none for an empty table."""
    if parts < 2:
        return []
    found = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 10_000)).first()[0]
    return sorted({int(c) for c in found or []})
