"""Mixing sources to target weights by Poisson replication.

Each listed source gets the mean repetition rate that brings it to its share of the mixed corpus. A document's number
of copies is the inverse of the Poisson distribution of that mean at a uniform number hashed from seed and id, so it
depends on nothing but the document, the seed and the rate, and a third of all rows in one source is just another
rate: no row meets the rows of its source. Copies are then exploded and dealt out by a hash of seed, id and copy, and
sorted by it within each partition: read one partition after another, the rows are in random order.

Sizes of sources are exact sums over all rows, folded before the shuffle to one row for each listed source; only these
reach the driver.

Defined cases: sources without a weight, null among them, are repeated at the mean rate ``epochs``, which keeps their
natural share. A listed source without rows gets nothing and its weight is shared by the others. Null ids hash as empty text, so
they share their number of copies; repeated ids likewise. A null text counts its separator only. A rate above
``max_rate`` raises, as no sensible mixture repeats a source so often. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.llm.common import keep_columns, quoted

#: Listed weights at most; they are broadcast.
MAX_WEIGHTS = 10_000
#: Hexadecimal digits of the uniform number: 52 bits, exact in a double.
DIGITS = 13


def poisson_steps(rate: float) -> list[float]:
    """The distribution function at 0, 1, 2, ... as far as a number of 52 bits can exceed it."""
    steps, k, total = [], 0, 0.0
    while True:
        term = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate > 0 else float(k == 0)
        total += term
        if total >= 1 - 2.0**-53 or (k > rate and term < 2.0**-60):
            return steps
        steps.append(total)
        k += 1


def uniform(seed: int, *keys: Column) -> Column:
    """Uniform number in [0, 1) from the hash of seed and keys; null keys count as empty text."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long") / F.lit(float(1 << 4 * DIGITS))


def rates(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0, text_col: str = "text", source_col: str = "source") -> dict[str, float]:
    """Mean repetition of each listed source. Size is bytes of text plus one separator for each document."""
    if len(weights) > MAX_WEIGHTS:
        raise ValueError(f"more than {MAX_WEIGHTS} weights")
    size = F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)) + 1
    listed = F.when(quoted(source_col).isin(*weights), quoted(source_col)) if weights else F.lit(None)
    rows = docs.groupBy(listed.alias("source")).agg(F.sum(size).alias("size")).collect()
    sizes = {r["source"]: r["size"] for r in rows if r["source"] is not None}
    total, parts = sum(sizes.values()), sum(w for s, w in sorted(weights.items()) if s in sizes)
    return {s: epochs * total * weights[s] / parts / n for s, n in sizes.items()}


def mix(
    docs: DataFrame, weights: dict[str, float], epochs: float = 1.0, seed: int = 0, max_rate: float = 10_000.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Columns of ``docs`` plus ``copy`` (from 0), ``copies`` and ``shuffle_key`` (hexadecimal); input columns of
    these names are replaced. ``weights`` are relative shares of the listed sources in the mixture; the mixture is about
    ``epochs`` times as large as the input.
    """
    spark = docs.sparkSession
    found = rates(docs, weights, epochs, text_col, source_col)
    if any(rate > max_rate for rate in found.values()):
        raise ValueError(f"a source would be repeated more than {max_rate} times: {found}")
    table = spark.createDataFrame([(s, poisson_steps(r)) for s, r in found.items()], "__llm_source string, __llm_steps array<double>")
    joined = docs.join(F.broadcast(table), quoted(source_col) == F.col("__llm_source"), "left")  # at most MAX_WEIGHTS rows
    natural = F.array(*[F.lit(x) for x in poisson_steps(epochs)]).cast("array<double>")
    id_ = quoted(id_col)
    counted = joined.withColumn("__llm_u", uniform(seed, id_)).withColumn("__llm_steps", F.coalesce("__llm_steps", natural))
    counted = counted.withColumn("__llm_copies", F.size(F.filter("__llm_steps", lambda step: step <= F.col("__llm_u"))))
    counted = counted.filter("__llm_copies > 0")
    kept = keep_columns(docs, "copy", "copies", "shuffle_key")
    exploded = counted.select(*kept, F.explode(F.sequence(F.lit(0), F.col("__llm_copies") - 1)).alias("copy"), F.col("__llm_copies").alias("copies"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}+"), F.coalesce(id_.cast("string"), F.lit("")), F.col("copy").cast("string")).cast("binary"))
    return exploded.withColumn("shuffle_key", key).repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")
