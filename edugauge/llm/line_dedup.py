"""Line dedup over batches with levelled sorted runs of line hashes.

A run is a stored table of line keys (two 64-bit hashes), bucketed and sorted by key, so that a merge join against it needs no
shuffle of the run. A new batch merge-joins its own keys with every run: a key found there has been seen before, the
others form the batch's own run on level 0. When a level holds ``fanout`` runs they are compacted into one run of the
next level, so a key is rewritten a logarithmic number of times and a batch meets few runs.

Batches have to come in rising order of ids, then the first holder of a key is its smallest id.

Defined cases: a null or empty text is one empty line. A null id counts as larger than any id. Rows that repeat an id
count as one document. Lines whose key has fewer than ``min_chars`` code points are never dropped. Ties (equal lines
within one document) stay or go together. Only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import ascii_lower, id_and_text, parallelism, quantiles, store
from edugauge.session import scratch_path

#: Blanks that are stripped at both ends of a line: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


class LineRuns:
    """The levelled runs of one corpus."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout, self.buckets = spark, fanout, parallelism(spark)
        self.levels: list[list[DataFrame]] = []

    def _write(self, keys: DataFrame) -> DataFrame:
        """A sorted run; the table's files lie in the shared scratch folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = keys.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", scratch_path(self.spark, name)).option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def _push(self, run: DataFrame, level: int = 0) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)  # keys of different runs differ
            self.levels[level] = []
            self._push(self._write(merged), level + 1)

    def add(self, batch: DataFrame) -> DataFrame:
        """Take ``(id, h1, h2)`` rows of a batch; return those whose lines are to be dropped."""
        first = batch.groupBy("h1", "h2").agg(F.min("id").alias("first_id")).withColumn("seen", F.lit(False))
        for run in [r for level in self.levels for r in level]:
            known = run.select("h1", "h2", F.col("first_id").alias("known_id")).hint("merge")
            first = first.join(known, ["h1", "h2"], "left").select(
                "h1", "h2", F.coalesce("known_id", "first_id").alias("first_id"), (F.col("seen") | F.col("known_id").isNotNull()).alias("seen")
            )
        first = store(first, "batch_keys")
        self._push(self._write(first.filter("not seen").drop("seen")))
        return batch.join(first.drop("seen"), ["h1", "h2"]).filter("id > first_id")


def keys_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Distinct ``(id, h1, h2)`` of the lines that can be dropped; a null id becomes the largest."""
    keys = F.filter(F.transform(_lines(F.col("_text")), line_key), lambda key: F.length(key) >= min_chars)
    hashes = F.array_distinct(F.transform(keys, _hashes))
    plain = id_and_text(docs, id_col, text_col)
    return plain.select(F.coalesce("_id", F.lit(LAST)).alias("id"), F.explode(hashes).alias("h")).select("id", "h.h1", "h.h2")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept`` (the text without its dropped lines).

    A line goes if its key is held by a document of a smaller id. ``batches`` id ranges of about equal size are taken
    one after the other.
    """
    spark = docs.sparkSession
    keys = keys_of(docs, id_col, text_col, min_chars)
    ids = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"))
    cuts = quantiles(ids, "id", batches)
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("id") > cut).cast("int")
    path = scratch_path(spark, "line_keys")
    keys.withColumn("batch", number).write.partitionBy("batch").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(T.StructType([*keys.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path)

    runs, dropped = LineRuns(spark, fanout), None
    for i in range(len(cuts) + 1):
        late = runs.add(stored.filter(F.col("batch") == i).drop("batch"))
        late = store(late.groupBy("id").agg(F.collect_list(F.struct("h1", "h2")).alias("gone")), "late_lines")
        dropped = late if dropped is None else dropped.unionByName(late)
    return _apply(id_and_text(docs, id_col, text_col), dropped, min_chars)


def _apply(plain: DataFrame, dropped: DataFrame, min_chars: int) -> DataFrame:
    lines = F.transform(
        _lines(F.col("_text")), lambda line: F.struct(line.alias("line"), line_key(line).alias("key"))
    )

    def stays(x: Column) -> Column:
        found = F.array_contains(F.col("gone"), _hashes(x["key"]))
        return F.when(F.length(x["key"]) >= min_chars, ~found).otherwise(F.lit(True))

    count = F.size(_lines(F.col("_text"))).cast("long")
    joined = plain.withColumn("id", F.coalesce("_id", F.lit(LAST))).join(dropped, "id", "left")
    kept = F.filter(lines, stays)
    whole = joined.filter(F.col("gone").isNull()).select(F.col("_id").alias("doc_id"), count.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("_text").alias("kept"))
    cut = joined.filter(F.col("gone").isNotNull()).select("_id", count.alias("n_lines"), kept.alias("stay"))
    cut = cut.select(
        F.col("_id").alias("doc_id"), "n_lines", (F.col("n_lines") - F.size("stay")).alias("n_dropped"),
        F.array_join(F.col("stay.line"), "\n").alias("kept"),
    )
    return whole.unionByName(cut)
