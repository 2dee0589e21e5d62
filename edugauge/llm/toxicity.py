"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the bag of its distinct words: their character n-grams (3 to 6 characters, within a word and its two
borders) and the words themselves, hashed into buckets. A word repeated over and over counts once. Bucket vectors are averaged and a linear softmax tells the two classes; vectors and softmax are trained jointly in
numpy with Adagrad steps. A misspelling never seen shares most of its n-grams with the word, and so its vectors. As the average
is linear, the trained model folds into one number for each bucket, which is what tasks use: the mean of the
numbers of a text's bag, plus a bias.

Training takes a bounded sample, ``max_docs`` labelled documents and ``max_bytes`` of text, chosen by hash in
equal parts from both classes; it runs on the driver, once for the model and once a fold for the cut. A text that does not fit what is left of the bytes is passed over. Every document is scored, by its whole text.

Defined cases: null and empty texts, and texts of blanks, have an empty bag and the score of the bias alone. Labels
that are null, or whose document is missing, are ignored. A repeated id trains once, by its shortest text (the smallest hash among
equally long ones), and is toxic if any of its labels says so. A class whose labelled texts are all too long for the sample raises.
Without labels of both classes every score is the share of label 1 (0 without labels). Columns of the table are kept
but for those that the result writes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import keep_columns, map_arrow, quoted, slices

BUCKET_BITS = 18
ORDERS = (3, 4, 5, 6)
BASE = np.uint32(0x01000193)
SPREAD = np.uint32(0x9E3779B1)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each text, in order, as one array of code points with blanks as 0; where each text starts."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "replace"), "<u4").copy()
    points[(points <= 32) | (points == 0x85) | (points == 0xA0)] = 0
    starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in lowered])[:-1]]).astype(np.int64)
    edges, ends = _words(points)
    key = (np.searchsorted(starts, edges, "right").astype(np.uint64) << np.uint64(32)) | _word_hashes(points, edges, ends)
    first = np.unique(key, return_index=True)[1]
    change = np.zeros(len(points) + 1, np.int8)
    change[edges[first]] += 1
    change[ends[first] + 1] -= 1  # with the blank behind the word
    kept = np.cumsum(change[:-1]) > 0
    kept[starts] = True  # the blank before the text
    return points[kept], (np.cumsum(kept) - 1)[starts]


def _words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blank = points == 0
    return np.flatnonzero(~blank[1:] & blank[:-1]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def _word_hashes(points: np.ndarray, edges: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """From a sum over the word's characters and one over its neighbouring pairs, both differences of running sums."""
    mixed = (points.astype(np.uint32) + np.uint32(1)) * SPREAD
    plain = np.concatenate([np.zeros(1, np.uint32), np.cumsum(mixed * (mixed >> np.uint32(7) | np.uint32(1)), dtype=np.uint32)])
    pairs = np.concatenate([np.zeros(2, np.uint32), np.cumsum((mixed[:-1] * BASE ^ mixed[1:]) * SPREAD, dtype=np.uint32)])
    return (plain[ends] - plain[edges]) * BASE + (pairs[ends] - pairs[np.minimum(edges + 1, ends)])


def subwords(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length, and for whole words: buckets and the positions where they start."""
    blank = points == 0
    before = np.concatenate([[0], np.cumsum(blank)])
    code = points.astype(np.uint32)
    mixed = (code + np.uint32(1)) * SPREAD
    h = mixed.copy()
    for n in range(2, max(ORDERS) + 1):
        if len(points) < n:
            return
        h = h[:-1] * BASE + mixed[n - 1 :]
        if n in ORDERS:
            size = len(points) - n + 1
            inner = before[n - 1 : n - 1 + size] - before[1 : 1 + size]
            at = np.flatnonzero(inner == 0)
            yield _bucket(h[at] + np.uint32(n)), at
    edges, ends = _words(points)
    if len(edges):
        yield _bucket(_word_hashes(points, edges, ends) + np.uint32(1)), edges


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h >> np.uint32(32 - BUCKET_BITS)


@dataclass
class Model:
    """Folded model: a number for each bucket and a bias."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        points, starts = _code_points(texts)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, at in subwords(points):
            cuts = np.searchsorted(at, [*starts, len(points)])
            sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets], dtype=np.float64)])
            total += sums[cuts[1:]] - sums[cuts[:-1]]
            count += np.diff(cuts)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -60, 60)))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    found = [b for b, _ in subwords(_code_points([text])[0])]
    buckets, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0))
    return buckets.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def _cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit with the least error of both classes, in the middle of its gap."""
    order = np.argsort(logits, kind="stable")
    ranked = labels[order]
    bad, good = np.concatenate([[0], np.cumsum(ranked)]), np.concatenate([[0], np.cumsum(1 - ranked)])
    wrong = bad / bad[-1] + (good[-1] - good) / good[-1]
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edges = np.concatenate([[logits[order[0]] - 1], logits[order], [logits[order[-1]] + 1]])
    return float((edges[best[0]] + edges[best[-1] + 1]) / 2)


def _learn(bags: list, labels: np.ndarray, rows: np.ndarray, dims: int, steps: int, batch: int, rate: float, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """A number for each bucket and the offset, by Adagrad over batches of equal parts of both classes of ``rows``."""
    rng = np.random.default_rng(seed)
    met = np.zeros(1 << BUCKET_BITS, np.float32)
    for i in rows:
        met[bags[i][0]] += 1
    trust = met / (met + np.float32(prior))
    vectors = np.zeros((1 << BUCKET_BITS, dims), np.float32)
    softmax = (rng.standard_normal((dims, 2)) * 0.5).astype(np.float32)
    shift = 0.0
    seen_v, seen_s = np.full(1 << BUCKET_BITS, 1e-7, np.float32), np.full(dims, 1e-2, np.float32)
    by_class = [rows[labels[rows] == c] for c in (0, 1)]
    truth = np.repeat((0, 1), batch // 2)
    mark, place = np.zeros(1 << BUCKET_BITS, bool), np.zeros(1 << BUCKET_BITS, np.int32)
    for _ in range(steps // batch):
        picked = [bags[i] for c in (0, 1) for i in rng.choice(by_class[c], batch // 2)]
        buckets = np.concatenate([b for b, _ in picked])
        shares = np.concatenate([s for _, s in picked]) * trust[buckets]
        owner = np.repeat(np.arange(batch), [len(b) for b, _ in picked])
        mark[buckets] = True
        touched = np.flatnonzero(mark)
        mark[touched] = False
        place[touched] = np.arange(len(touched), dtype=np.int32)
        at = place[buckets]
        own, apart = vectors[touched], softmax[:, 1] - softmax[:, 0]
        logit = np.bincount(owner, shares * np.einsum("ij,j->i", own, apart)[at], batch) + shift
        # with two classes the errors of both are opposite, so a bucket's slope is one number times ``apart``
        error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - truth) / batch
        pull = np.bincount(at, shares * error[owner], len(touched)).astype(np.float32)
        slope = np.einsum("i,ij->j", pull, own)
        seen_s += slope**2
        step = rate * slope / np.sqrt(seen_s)
        softmax += np.stack([step, -step], 1)
        shift -= 0.2 * error.sum()
        seen_v[touched] += pull**2 * (apart @ apart)
        vectors[touched] -= np.outer(rate * pull / np.sqrt(seen_v[touched]), apart)
    return (vectors @ (softmax[:, 1] - softmax[:, 0]) * trust).astype(np.float32), float(shift)


def train(texts: list[str], labels: list[int], dims: int = 8, steps: int = 16_000, batch: int = 32, rate: float = 1.0, prior: float = 1.0, folds: int = 3, seed: int = 1) -> Model:
    """Vectors and softmax trained jointly, and the cut of the scores.

    Every bucket met is learned. Its share of a bag is weighted by ``n / (n + prior)``, n being the training texts that
    hold it, so that what one text alone holds is learned less than what many do. The bias puts the cut with the
    least error of both classes at a score of 0.5; errors are counted on texts that a model of the other ``folds``
    has not met (equal texts share a fold). With a class of fewer than two distinct texts the cut is that of the training texts.
    """
    known = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        share = float(labels[0]) if labels else 0.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 60.0 if share else -60.0)
    bags = [bag(text) for text in texts]
    options = (dims, steps, batch, rate, prior, seed)
    everyone = np.arange(len(texts))
    folded, offset = _learn(bags, known, everyone, *options)
    fold = np.zeros(len(texts), np.int64)
    for c in (0, 1):  # both classes are dealt out to all folds, equal texts to one
        places: dict[str, int] = {}
        for i in np.flatnonzero(known == c):
            fold[i] = places.setdefault(texts[i], len(places)) % folds
    logits = np.array([float(s @ folded[b]) + offset for b, s in bags])
    if all(len(set(fold[known == c])) > 1 for c in (0, 1)):
        for k in range(folds):
            out, rest = everyone[fold == k], everyone[fold != k]
            if len(out):
                numbers, shift = _learn(bags, known, rest, *options)
                logits[out] = [float(bags[i][1] @ numbers[bags[i][0]]) + shift for i in out]
    return Model(folded, offset - _cut(logits, known))


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str, text_col: str, max_docs: int, max_bytes: int) -> tuple[list[str], list[int]]:
    """The bounded sample: half of it from each class, smallest hashes first, as many as fit ``max_bytes``."""
    known = labels.filter(~held_out & F.col("toxic").isin(0, 1)).groupBy(quoted(id_col).alias("__llm_id")).agg(F.max("toxic").cast("int").alias("__llm_toxic"))
    texts = docs.select(quoted(id_col).alias("__llm_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("__llm_text"))
    texts = texts.withColumn("__llm_rank", F.struct(F.octet_length("__llm_text").alias("size"), F.xxhash64("__llm_text").alias("hash")))
    sized = texts.select("__llm_id", "__llm_rank").join(known, "__llm_id").groupBy("__llm_id", "__llm_toxic").agg(F.min("__llm_rank.size").alias("size")).withColumn("h", F.xxhash64("__llm_id"))
    picked, most = {}, max_bytes // 2
    for label in (0, 1):
        own = sized.filter(F.col("__llm_toxic") == label)
        left, before = most, len(picked)
        for row in own.filter(F.col("size") <= most).orderBy("h", "__llm_id").limit(max_docs // 2).collect():
            if row["size"] <= left:
                left -= row["size"]
                picked[row["__llm_id"]] = label
        if len(picked) == before and not own.isEmpty():
            raise ValueError(f"no labelled text of class {label} fits the sample of {max_docs} documents and {max_bytes} bytes")
    if not picked:
        return [], []
    chosen = F.broadcast(docs.sparkSession.createDataFrame(list(picked.items()), "__llm_id long, __llm_toxic int"))  # max_docs rows
    found = texts.join(chosen, "__llm_id").groupBy("__llm_id", "__llm_toxic").agg(F.min_by("__llm_text", "__llm_rank").alias("__llm_text")).collect()
    found = sorted((r["__llm_id"], r["__llm_text"], r["__llm_toxic"]) for r in found)
    return [t for _, t, _ in found], [c for _, _, c in found]


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 6000, max_bytes: int = 48 << 20) -> Model:
    """Train on the labelled documents for which ``held_out`` (an expression on the id column) is false."""
    return train(*training_rows(docs, labels, held_out, id_col, text_col, max_docs, max_bytes))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` plus ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number for each bucket
    kept = keep_columns(docs, "score")
    plain = docs.select(*kept, quoted(text_col).cast("string").alias("__llm_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            scores = shared.value.score([t.as_py() or "" for t in batch.column(batch.num_columns - 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    return map_arrow(plain, run, schema)
