"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Settings worth having on any cluster. The JVM does not compile methods above 8000 bytes of
# bytecode, so a wide projection fused into one larger method runs interpreted; with the limit
# Spark generates smaller methods for such a stage instead.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_own_folder: str | None = None
_shipped: set[str] = set()


def local_session(cores: int | str = 8, app: str = "edugauge", **conf: str) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EDUGAUGE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_wide_projections(spark: SparkSession) -> None:
    """Give a session that keeps Spark's own bound for generated methods the recommended one.

    The layers cast, clean and label some twenty columns a row; fused with a join they become one method that the JVM
    only interprets. A bound that the cluster has chosen itself stays.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) == 65535:
        spark.conf.set(key, RECOMMENDED[key])


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.
    Only on one machine (a ``local`` master, as in tests) a temporary one is chosen where none is named.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^-\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="edugauge-")
    return _own_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path for an intermediate table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation of everything upstream, and later
    passes read only the columns they use.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="edugauge-code-")) / "edugauge_package.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for path in sorted(root.rglob("*.py")):
            target.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
