"""Document fingerprints by winnowing.

Every k-gram of code points has a rolling hash. In each window of ``window`` neighbouring k-grams the smallest hash is
selected, the rightmost one among equals, and its position is kept. Two texts that share a passage of at least
``window + k - 1`` code points therefore share a selected hash, and the positions say where. A text with fewer k-grams
than a window has one window; a text shorter than k is its own only gram; an empty text has no fingerprint.

The likeness of two fingerprints is the Jaccard similarity of their hash sets; of two empty ones it is 1, of an empty
and another 0. Equal texts have equal fingerprints.

Defined cases: null texts are empty; texts of any length are taken whole, block by block; repeated rows are fingerprinted
each. ``with_next`` orders rows by id (nulls first) and, among equal ids, by text. Columns of the table are kept but
for those that the result writes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import id_and_text, keep_columns, map_arrow, parallelism, quantiles, quoted, ship, slices

K, WINDOW = 10, 31
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: k-grams hashed at once; positions within a block fit the low half of a word.
BLOCK = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        ones = np.ones(size, np.uint64)
        ones[1:] = BASE
        back = np.ones(size, np.uint64)
        back[1:] = INVERSE
        _powers[size] = (np.cumprod(ones, dtype=np.uint64), np.cumprod(back, dtype=np.uint64))
    up, down = _powers[size]
    return up[:n], down[:n]


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams: differences of running sums of powers, which is the rolling hash for all positions."""
    up, down = _tables(len(points))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    h = (sums[k:] - sums[:-k]) * down[: len(points) - k + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(32)


def select(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (unsigned 32-bit) and positions of the selected k-grams, by position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    k = min(k, len(points))
    grams = len(points) - k + 1
    found = []
    for start in range(0, max(1, grams - window + 1), BLOCK):
        stop = min(grams, start + BLOCK + window - 1)
        h = gram_hashes(points[start : stop + k - 1], k)
        # the smaller key is the smaller hash, then the position further right
        key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
        width, span = 1, min(window, len(h))
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < span:
            key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        found.append((key >> np.uint64(32), np.int64(start) + (np.uint64(0xFFFFFFFF) - (key & np.uint64(0xFFFFFFFF))).astype(np.int64)))
    hashes, places = (np.concatenate(x) for x in zip(*found))
    places, first = np.unique(places, return_index=True)
    return hashes[first].astype(np.uint32), places


def packed(hashes: np.ndarray, places: np.ndarray) -> str:
    """Text form: base64 of the number of selections, the hashes and the gaps between positions (variable length)."""
    gaps = np.diff(places, prepend=0)
    parts = []
    while len(gaps) and gaps.any():
        parts.append((gaps & 0xFF).astype(np.uint8))
        gaps = gaps >> 8
    planes = b"".join(bytes((1,)) + p.tobytes() for p in parts)
    return base64.b64encode(len(hashes).to_bytes(4, "little") + hashes.astype("<u4").tobytes() + planes).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def fingerprint(docs: DataFrame, text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Columns of ``docs`` plus ``hashes`` and ``places`` (arrays of longs)."""
    kept = keep_columns(docs, "hashes", "places")
    plain = docs.select(*kept, quoted(text_col).cast("string").alias("__llm_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [select(t.as_py() or "", k, window) for t in batch.column(batch.num_columns - 1)]
            new = [pa.array([x[i].astype(np.int64) for x in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "hashes", "places"])

    longs = T.ArrayType(T.LongType())
    return map_arrow(plain, run, T.StructType([*plain.schema.fields[:-1], T.StructField("hashes", longs), T.StructField("places", longs)]))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows ``bucket, extra, _id, _text`` dealt so that each bucket is one run of ids in order, followed by the document
    that comes next (``extra``); after the last document of all comes the first. Each text moves once, but for one in a bucket.
    """
    plain = id_and_text(docs, id_col, text_col)
    parts = parallelism(docs.sparkSession)
    cuts = quantiles(plain, "_id", parts)
    bucket = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_id"))), F.lit(0)) if cuts else F.lit(0)
    dealt = plain.withColumn("bucket", F.when(F.col("_id").isNull(), F.lit(-1)).otherwise(bucket))
    # one row for each bucket: its first id, and the bucket before it, which needs that document too
    firsts = sorted((r["bucket"], r["first"]) for r in dealt.groupBy("bucket").agg(F.min("_id").alias("first")).collect())
    heads = [(b, first, firsts[i - 1][0]) for i, (b, first) in enumerate(firsts)]
    table = docs.sparkSession.createDataFrame(heads, "bucket int, first long, before int")
    dealt = dealt.join(F.broadcast(table), "bucket")
    heads = F.when(F.col("_id").eqNullSafe(F.col("first")), F.col("before"))
    copies = F.filter(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")), F.struct(heads.alias("bucket"), F.lit(True).alias("extra"))), lambda x: x["bucket"].isNotNull())
    spread = dealt.select("_id", "_text", F.explode(copies).alias("at")).select("at.bucket", "at.extra", "_id", "_text")
    return spread.repartition(parts, "bucket").sortWithinPartitions("bucket", "extra", F.col("_id").asc_nulls_first(), "_text")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last half of its code points replaced by the first ones of the
    next document), and the likeness to both the edited text and the next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, None  # the row that waits for the next one; the bucket whose extra row was met
        for batch in slices(batches):
            out = []
            for bucket, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if extra and bucket == done:
                    continue  # rows that repeat the first id of the next bucket
                chosen = select(text, k, window)
                if held is not None and held[0] == bucket:
                    out.append(_row(held[1], held[2], held[3], text, chosen, k, window))
                held, done = ((bucket, doc_id, text, chosen), done) if not extra else (None, bucket)
            yield pa.RecordBatch.from_pylist(out, SCHEMA)

    ship(docs.sparkSession)
    return with_next(docs, id_col, text_col).mapInArrow(run, RESULT)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, selections int"
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("selections", pa.int32()),
])


def _row(doc_id, text: str, chosen, following: str, following_chosen, k: int, window: int) -> dict:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    other = select(edited, k, window)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": packed(*chosen), "edited_fingerprint": packed(*other),
        "near_edited": likeness(chosen[0], other[0]), "near_next": likeness(chosen[0], following_chosen[0]), "selections": len(chosen[0]),
    }
