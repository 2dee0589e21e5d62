"""Language ID by nearest centroids.

A text is a vector of hashed character n-grams (1 to 3 letters, words bordered by blanks), weighted by TF-IDF and
normalised. Document frequencies are counted over all training rows. Each language has several centroids, found by
spherical k-means over a bounded sample of its rows (``sample_rows``, smallest hashes). A text gets the language of the centroid with the largest
cosine; it is marked as rejected if even that one is farther than ``reject_distance``.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything if nothing was learned.
Training rows without language or letters are ignored. Ties go to the first language in order. Repeated rows
count as often as they occur, but the sample takes an id once. Columns of the table are kept but for those that the
result writes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import keep_columns, map_arrow, quoted, ship, slices

BUCKETS = 1 << 13
ROWS = 64
#: Languages that can be learned; their centroids are broadcast.
MAX_LANGUAGES = 1000
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def counts(texts: list[str]) -> np.ndarray:
    """n-gram counts, one row of ``BUCKETS`` for each text."""
    joined = " " + "  ".join(t.lower() for t in texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    starts = np.concatenate([[0], np.cumsum([len(t.lower()) + 2 for t in texts])[:-1]]).astype(np.int64)
    code = np.where(_is_letter()[points], points, 0).astype(np.uint32)
    kept = (code != 0) | (np.concatenate([[1], code[:-1]]) != 0)
    kept[starts] = True  # every text begins with a blank of its own
    owner = np.repeat(np.arange(len(texts)), np.diff([*starts, len(code)]))[kept] * BUCKETS
    code = code[kept]
    mixed = (code + np.uint32(1)) * np.uint32(0x9E3779B1)
    out = np.zeros(len(texts) * BUCKETS, np.int64)
    h = mixed.copy()
    for n in (1, 2, 3):
        if n > 1:
            h = h[:-1] * np.uint32(0x01000193) + mixed[n - 1 :]
        some = code[: len(h)] != 0
        for i in range(1, n):
            some |= code[i : i + len(h)] != 0
        inner = code[1 : 1 + len(h)] != 0 if n == 3 else True
        at = np.flatnonzero(some & inner)
        g = h[at] + np.uint32(n)
        g = (g ^ (g >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        out += np.bincount(owner[at] + (g >> np.uint32(19)), minlength=len(out))
    return out.reshape(len(texts), BUCKETS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors; zero without letters."""
    v = np.log1p(counts(texts)).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def centroids_of(v: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from the first rows that are farthest from those taken before."""
    chosen = [0]
    for _ in range(min(k, len(v)) - 1):
        chosen.append(int(np.argmin((v @ v[chosen].T).max(1))))
    centers = v[chosen].copy()
    for _ in range(rounds):
        nearest = (v @ centers.T).argmax(1)
        for c in range(len(centers)):
            if (nearest == c).any():
                centers[c] = v[nearest == c].mean(0)
                centers[c] /= max(1e-12, float(np.linalg.norm(centers[c])))
    return centers


def fit(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", clusters: int = 3, sample_rows: int = 500):
    """``(idf, languages, centroids)`` from rows with a language for which ``held_out`` is false."""
    ship(docs.sparkSession)
    known = docs.filter(~held_out & quoted(lang_col).isNotNull() & quoted(text_col).rlike(r"\p{L}"))
    known = known.select(quoted(id_col).cast("long").alias("id"), quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches, ROWS):
            texts = [t.as_py() for t in batch.column(0)]
            total += (counts(texts) > 0).sum(0)
            rows += len(texts)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(BUCKETS + 1, dtype=np.int32), "df": np.append(total, rows)})

    found = known.select("text").mapInArrow(frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(BUCKETS + 1)
    for row in found:  # one number for each bucket
        df[row["bucket"]] = row["df"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + np.float32(0.1)

    order = Window.partitionBy("lang").orderBy("h", "id")
    ranked = known.select("id", "lang", F.xxhash64("id").alias("h")).withColumn("n", F.row_number().over(order))
    chosen = ranked.filter(F.col("n") <= sample_rows).select("id").limit(MAX_LANGUAGES * sample_rows + 1).collect()
    if len(chosen) > MAX_LANGUAGES * sample_rows:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not chosen:
        return idf, [], np.zeros((0, BUCKETS), np.float32)
    ids = F.broadcast(docs.sparkSession.createDataFrame([(r["id"],) for r in chosen], "id long").distinct())  # bounded above
    sample = known.join(ids, "id").dropDuplicates(["id", "lang"])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id"])
        v = np.concatenate([vectors(rows["text"].iloc[i : i + ROWS].tolist(), idf) for i in range(0, len(rows), ROWS)])
        centers = centroids_of(v, clusters)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "center": [c.tolist() for c in centers]})

    # at most sample_rows rows of a language meet in a task
    rows = sample.groupBy("lang").applyInPandas(cluster, "lang string, center array<float>").collect()
    rows = sorted((r["lang"], r["center"]) for r in rows)
    return idf, [lang for lang, _ in rows], np.array([c for _, c in rows], np.float32)


def predict(docs: DataFrame, model, text_col: str = "text", reject_distance: float = 0.8) -> DataFrame:
    """Columns of ``docs`` plus ``lang_pred``, ``score`` (the cosine) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = keep_columns(docs, "lang_pred", "score", "rejected")
    plain = docs.select(*kept, quoted(text_col).cast("string").alias("__llm_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, languages, centers = shared.value
        for batch in slices(batches, ROWS):
            v = vectors([t.as_py() or "" for t in batch.column(batch.num_columns - 1)], idf)
            cosine = np.clip(v @ centers.T, 0, 1) if languages else np.zeros((len(v), 1))
            best, lettered = cosine.argmax(1), v.any(1) & bool(languages)
            names = [languages[i] if ok else UNDETERMINED for i, ok in zip(best, lettered)]
            score = np.where(lettered, cosine.max(1), 0.0).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score), pa.array((1 - score > reject_distance).tolist(), pa.bool_())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
            )

    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return map_arrow(plain, run, T.StructType([*plain.schema.fields[:-1], *new]))
