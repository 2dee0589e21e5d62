"""Stored results of search trials, so that an interrupted search goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "trial string, params string, fold int, auc double"


def fingerprint(df: DataFrame) -> str:
    """Digest of the rows of a table in any order, and of its columns."""
    columns = sorted(df.columns)
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")
    total, rows = df.agg(F.sum(hashed), F.count(F.lit(1))).first()
    return hashlib.sha256(json.dumps([columns, str(total), rows]).encode()).hexdigest()


def trial_key(data: str, params: Mapping, fold: int, settings: Mapping) -> str:
    """Name of a trial: what it was fitted on, with which parameters, and how."""
    return hashlib.sha256(json.dumps([data, dict(params), fold, dict(settings)], sort_keys=True).encode()).hexdigest()


@dataclass
class Ledger:
    """Trials in a folder that outlives the job; without a folder they are kept for one search only.

    Each finished fit adds a table of its own below the folder, so a trial is either stored whole or not at all.
    """

    spark: SparkSession
    path: str | None = None
    known: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.path is None:
            return
        try:
            stored = self.spark.read.schema(SCHEMA).parquet(f"{self.path.rstrip('/')}/trials-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            self.known = {row["trial"]: row["auc"] for row in stored.collect()}  # a row for each trial of a search

    def add(self, trials: Sequence[tuple[str, Mapping, int, float]]) -> None:
        """Store trials ``(key, parameters, fold, auc)``."""
        self.known |= {key: auc for key, _, _, auc in trials}
        if self.path is not None and trials:
            rows = [(key, json.dumps(dict(params), sort_keys=True), fold, auc) for key, params, fold, auc in trials]
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.path.rstrip('/')}/trials-{uuid.uuid4().hex}")
