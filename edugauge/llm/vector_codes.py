"""Compression of vectors to codes: each vector is cut into parts, each part becomes the number of the nearest entry of a codebook.

The nearest entry is found by slice and intersect. For every dimension of a part, the entries are sorted by their
coordinate, and prefix masks tell which entries are among the first i of them, one bit an entry in a 64-bit word. An
initial radius, the distance to the closest of the entries that are next to the vector in the order of some dimension, cuts
a slice out of each order: the XOR of two prefix masks. The AND of the slices over all dimensions is a mask of the
entries in the box around the vector. It holds every entry within the radius, so the nearest one (or the first of several)
among the candidates is the nearest of all, exactly.

Codebooks are trained by rounds of assignment and integer means. A task adds up its own vectors; only sums by part, entry
and position are shuffled, and only the codebook itself reaches the driver.

Defined cases: a vector that is null or holds a null or a component that is not finite takes no part. Shorter vectors are
filled up with zeros to the longest length, and that to a multiple of the parts. Ids may repeat or be null; null ids come
last in the order that starts the codebooks, and equal ids are ordered by their vectors. Fewer vectors than entries
give smaller codebooks; an empty table gives an empty result. Components of 2 ** 26 and more in whole numbers (for parts of
four dimensions) raise, since distances would leave 64 bits. Columns of the table are kept, but for those that the result writes.
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

#: Vectors that a task works on at a time.
ROWS = 4096


def is_whole(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector.cast("array<double>"), finite)


def rows_of(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Matrix of ``floor(scale * x)``, filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


@dataclass
class Codebooks:
    """``entries[part, entry, position]`` in whole numbers of ``1 / scale``."""

    entries: np.ndarray
    scale: int

    def __post_init__(self) -> None:
        parts, count, _ = self.entries.shape
        self.order = np.argsort(self.entries, axis=1, kind="stable").transpose(0, 2, 1)  # part, dimension, place
        self.sorted = np.take_along_axis(self.entries.transpose(0, 2, 1), self.order, axis=2)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        start = np.zeros((*bits.shape[:2], 1), np.uint64)
        self.prefixes = np.concatenate([start, np.bitwise_or.accumulate(bits, axis=2)], axis=2) if count else start

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def candidates(self, part: int, x: np.ndarray) -> np.ndarray:
        """Mask of entries for each row of ``x``: all entries in a box that holds the nearest one."""
        entries, last = self.entries[part], self.entries.shape[1] - 1
        least = None
        for d in range(x.shape[1]):
            at = np.searchsorted(self.sorted[part, d], x[:, d])
            for near in (np.minimum(at, last), np.maximum(at - 1, 0)):
                distance = ((x - entries[self.order[part, d, near]]) ** 2).sum(axis=1)
                least = distance if least is None else np.minimum(least, distance)
        radius = np.sqrt(least.astype(np.float64)).astype(np.int64) + 1
        mask = np.full(len(x), np.iinfo(np.uint64).max, np.uint64)
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[part, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[part, d], x[:, d] + radius, "right")
            mask &= self.prefixes[part, d, high] ^ self.prefixes[part, d, low]
        return mask

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the first of several) and the squared distance, for each row."""
        mask = self.candidates(part, x)
        row, entry = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        distance = ((x[row] - self.entries[part, entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(distance << 6 | entry, np.searchsorted(row, np.arange(len(x))))
        return best & 63, best >> 6

    def text(self) -> str:
        """All components by part, entry and position."""
        return ",".join(map(str, self.entries.ravel().tolist()))


def fit(df: DataFrame, id_col: str, vector_col: str, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks:
    """Codebooks that start as the vectors of the smallest ids, after so many rounds over all vectors."""
    if not 1 <= entries <= 64:
        raise ValueError("a mask holds 1 to 64 entries")
    vector = quoted(vector_col).cast("array<double>")
    kept = df.filter(is_whole(quoted(vector_col))).select(quoted(id_col).alias("id"), vector.alias("v"))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    longest, top = kept.agg(F.max(F.size("v")), F.max(largest)).first()
    width = max(1, -(-(longest or 0) // parts))
    if ((top or 0) * scale + 1) ** 2 * 4 * width * 64 >= 2.0**63:
        raise ValueError("components too large for distances in 64 bits")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()  # one codebook
    book = Codebooks(rows_of(first["v"], parts * width, scale).reshape(-1, parts, width).transpose(1, 0, 2), scale)
    for _ in range(rounds if first.num_rows else 0):
        book = Codebooks(_moved(kept, book), scale)
    return book


def _moved(kept: DataFrame, book: Codebooks) -> np.ndarray:
    """Entries at the integer means of their parts; unused ones stay."""
    parts, count, width = book.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, used = np.zeros(book.entries.shape, np.int64), np.zeros((parts, count), np.int64)
        for batch in slices(batches, ROWS):
            x = rows_of(batch["v"], book.dims, book.scale).reshape(-1, parts, width)
            for p in range(parts):
                entry, _ = book.nearest(p, x[:, p])
                np.add.at(sums[p], entry, x[:, p])
                used[p] += np.bincount(entry, minlength=count)
        met = np.flatnonzero(np.repeat(used.ravel(), width))
        columns = (met, np.repeat(used.ravel(), width)[met], sums.ravel()[met])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "n", "total"])

    schema = T._parse_datatype_string("place long, n long, total long")
    added = map_arrow(kept.select("v"), add, schema).groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = added.toArrow()  # as large as the codebooks at most
    place, n, total = (found[c].to_numpy() for c in ("place", "n", "total"))
    moved = book.entries.ravel().copy()
    moved[place] = total // n
    return moved.reshape(book.entries.shape)


def encode(df: DataFrame, book: Codebooks, vector_col: str) -> DataFrame:
    """Columns of ``df`` without the vector, plus ``code`` (binary, one byte a part) and ``error`` (long, the squared distances summed)."""
    kept = keep_columns(df, vector_col, "code", "error")
    plain = df.filter(is_whole(quoted(vector_col))).select(*kept, quoted(vector_col).cast("array<double>").alias("__llm_vector"))
    parts, _, width = book.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            x = rows_of(batch.column(batch.num_columns - 1), book.dims, book.scale).reshape(-1, parts, width)
            found = [book.nearest(p, x[:, p]) for p in range(parts)]
            code = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            error = np.sum([distance for _, distance in found], axis=0)
            columns = [pa.array(list(map(bytes, code)), pa.binary()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "code", "error"])

    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    return map_arrow(plain, run, schema)


def decode(df: DataFrame, book: Codebooks, code_col: str = "code") -> DataFrame:
    """Columns of ``df`` plus ``decoded`` (array of double): the entries that a code names, side by side."""
    kept = keep_columns(df, "decoded")
    plain = df.select(*kept, quoted(code_col).alias("__llm_code"))
    parts = np.arange(book.entries.shape[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            codes = batch.column(batch.num_columns - 1).to_pylist()
            found = [None if c is None else (book.entries[parts, list(c)].ravel() / book.scale).tolist() for c in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "decoded"])

    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("decoded", T.ArrayType(T.DoubleType()))])
    return map_arrow(plain, run, schema)
