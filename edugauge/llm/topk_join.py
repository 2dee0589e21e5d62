"""Exact search for the rows of the largest inner product, as a Voronoi join of queries with all rows.

Pivots cut the space into cells; every row belongs to the cell of its nearest pivot. For a query q the row x of the
largest product is the one of the smallest ``f = |q - x|^2 - |x|^2``, since ``f = |q|^2 - 2 q x``. A summary by cell and ring (rows at
about the same distance from the pivot) holds counts and the extremes of distance and length. With the triangle
inequality it bounds f for all queries of one cell and all rows of one ring from both sides: the upper bounds give a limit
that at least k + 1 rows stay within (one may be the query itself), and a ring whose lower bound is above the limit cannot
help any query of the cell. The other rings are replicated to the cell's queries, dealt into blocks of bounded size by a hash. Each
block is solved by itself, and the best of the blocks are merged by query.

Nothing is approximate: bounds only leave out rows that cannot be among the best, and where they do not separate anything (random
directions) every block of rows meets every cell of queries. A cell with many queries is cut into chunks, a cell with many
rows into blocks, so that a hot vector is only more blocks.

Defined cases: a vector that is null or holds a null or a component that is not finite takes no part. Shorter vectors are
filled up with zeros. Every row is a candidate for every query but itself; ids may repeat or be null (null ids are last
among equal scores), and each row that is a query gets its own ranks. Fewer candidates than k give fewer ranks; an empty
table gives an empty result. Products beyond 2 ** 62 raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import map_arrow, quoted, slices, store
from edugauge.llm.vector_codes import is_whole, rows_of

#: Cells at least and at most, and queries that a cell should hold about.
FEWEST_CELLS, MOST_CELLS, CELL_QUERIES = 8, 256, 4096
#: Rows and queries that one task solves at most, about.
BLOCK_ROWS, CHUNK_ROWS = 8192, 16384
#: Scores held at a time.
SCORES = 1 << 21

PLACED = "uid long, id long, v binary, is_query boolean, cell int, ring int, distance long, norm long"
FOUND = "uid long, query_id long, vec_id long, other long, score long"


def _place(pivots: np.ndarray, dims: int, scale: int, kind: str):
    """Nearest pivot, squared distance to it and squared length of each row."""
    lengths = (pivots.astype(np.float64) ** 2).sum(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            uid, ident, vector, asks = batch.columns
            x = rows_of(vector, dims, scale)
            near = (lengths - 2.0 * (x.astype(np.float64) @ pivots.T.astype(np.float64))).argmin(axis=1)
            distance, norm = ((x - pivots[near]) ** 2).sum(axis=1), (x**2).sum(axis=1)
            ring = (2 * np.log2(1.0 + distance)).astype(np.int32)
            packed = pa.array(list(map(bytes, x.astype(kind))), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [uid, ident, packed, asks, pa.array(near, pa.int32()), pa.array(ring), pa.array(distance), pa.array(norm)],
                names=[*batch.schema.names, "cell", "ring", "distance", "norm"],
            )

    return place


def needed_rings(pivots: np.ndarray, summary: list[dict], k: int) -> dict[int, list[dict]]:
    """For each cell that holds queries the rings that may hold one of their ``k`` best rows."""
    x = pivots.astype(np.float64)
    cells, counts = np.array([s["cell"] for s in summary]), np.array([s["n"] for s in summary])
    near, far = (np.sqrt(np.array([s[c] for s in summary], np.float64)) for c in ("nearest", "farthest"))
    short, long = (np.array([s[c] for s in summary], np.float64) for c in ("shortest", "longest"))
    found = {}
    for cell in sorted({s["cell"] for s in summary if s["queries"]}):
        reach = max(float(s["query_farthest"]) for s in summary if s["cell"] == cell and s["queries"]) ** 0.5
        between = np.sqrt(((x[cells] - x[cell]) ** 2).sum(axis=1))
        upper = (between + reach + far) ** 2 - short
        lower = np.maximum(0.0, np.maximum(between - reach - far, near - between - reach)) ** 2 - long
        order = np.argsort(upper, kind="stable")
        enough = np.searchsorted(np.cumsum(counts[order]), k + 1)  # one of them may be the query itself
        limit = upper[order[enough]] if enough < len(order) else np.inf
        slack = 1e-6 * (1.0 + np.abs(upper).max())
        found[cell] = [summary[i] for i in np.flatnonzero(lower <= limit + slack)]
    return found


def best_rows(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``query, row, score`` of the ``k`` largest products of each query, equal ones in the order of the rows, piece by piece.

    ``own`` is the row that a query has to leave out, or -1.
    """
    n = len(rows)
    most = float((queries.astype(np.float64) ** 2).sum(axis=1).max() * (rows.astype(np.float64) ** 2).sum(axis=1).max()) ** 0.5
    kind = np.float64 if most < 2.0**52 else np.int64
    columns, order = rows.astype(kind).T, np.arange(n)
    for start in range(0, len(queries), step := max(1, SCORES // n)):
        scores = queries[start : start + step].astype(kind) @ columns
        mine = own[start : start + step]
        keys = scores * n - order if kind is np.float64 and most * n < 2.0**52 else None
        if keys is not None:  # one number decides by score and place
            keys[mine >= 0, mine[mine >= 0]] = -np.inf
            top = np.argpartition(keys, n - min(n, k), axis=1)[:, n - min(n, k) :]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, axis=1), axis=1), axis=1)
        else:
            top = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
        query = np.repeat(np.arange(len(scores)), top.shape[1]).reshape(top.shape)
        other = top != mine[:, None]
        other &= np.cumsum(other, axis=1) <= k
        yield start + query[other], top[other], scores[query[other], top[other]].astype(np.int64)


def _solve(kind: str, k: int):
    def solve(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["uid", "query_id", "vec_id", "other", "score"]
        found = [[] for _ in names]
        if queries.num_rows and rows.num_rows:
            rows = rows.sort_by([("id", "ascending"), ("uid", "ascending")])  # nulls are last
            q, x = (np.frombuffer(b"".join(t["v"].to_pylist()), kind).reshape(t.num_rows, -1) for t in (queries, rows))
            uid, asked = rows["uid"].to_numpy(), queries["uid"].to_numpy()
            by_uid = np.argsort(uid)
            at = by_uid[np.minimum(np.searchsorted(uid, asked, sorter=by_uid), len(uid) - 1)]
            for query, row, score in best_rows(q, x, np.where(uid[at] == asked, at, -1), k):
                query, row = pa.array(query), pa.array(row)
                part = (queries["uid"].take(query), queries["id"].take(query), rows["id"].take(row), rows["uid"].take(row), pa.array(score))
                for chunks, column in zip(found, part):
                    chunks.extend(column.chunks if isinstance(column, pa.ChunkedArray) else [column])
        return pa.table([pa.chunked_array(chunks, pa.int64()) for chunks in found], names=names)

    return solve


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows of the largest integer inner product, for each row that ``is_query``."""
    spark = df.sparkSession
    vector = quoted(vector_col).cast("array<double>")
    kept = df.filter(is_whole(quoted(vector_col))).select(
        F.monotonically_increasing_id().alias("uid"), quoted(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    dims, top, queries = kept.agg(F.max(F.size("v")), F.max(largest), F.count_if("is_query")).first()
    dims, top = max(1, dims or 0), (top or 0.0) * scale + 1
    if dims * top**2 >= 2.0**62:
        raise ValueError("components too large for products in 64 bits")
    kind = next(kind for kind, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if top < 2.0**bits)
    wanted = min(MOST_CELLS, max(FEWEST_CELLS, -(-queries // CELL_QUERIES)))
    drawn = kept.select(F.xxhash64("uid").alias("h"), "v").orderBy("h").limit(8 * wanted).toArrow()
    pivots = spread_pivots(rows_of(drawn["v"], dims, scale), wanted)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    placed = store(map_arrow(kept, _place(pivots, dims, scale, kind), T._parse_datatype_string(PLACED)), "cells")
    summary = placed.groupBy("cell", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("nearest"), F.max("distance").alias("farthest"), F.min("norm").alias("shortest"),
        F.max("norm").alias("longest"), F.count_if("is_query").alias("queries"), F.max(F.when(F.col("is_query"), F.col("distance"))).alias("query_farthest"),
    )
    summary = [r.asDict() for r in summary.orderBy("cell", "ring").collect()]  # cells by at most 126 rings
    needed = needed_rings(pivots, summary, k)
    groups, targets = [], {}
    for cell, rings in needed.items():
        asked = sum(s["queries"] for s in summary if s["cell"] == cell)
        group = (cell, -(-sum(s["n"] for s in rings) // BLOCK_ROWS), -(-asked // CHUNK_ROWS))
        groups.append(group)
        for s in rings:
            targets.setdefault((s["cell"], s["ring"]), []).append(group)
    # Both tables are bounded by the numbers of cells and rings.
    group_kind = "group int, blocks int, chunks int"
    to = F.broadcast(spark.createDataFrame([(c, r, g) for (c, r), g in targets.items()], f"cell int, ring int, to array<struct<{group_kind.replace(' int', ': int')}>>"))
    of = F.broadcast(spark.createDataFrame(groups, group_kind))

    rows = placed.join(to, ["cell", "ring"]).select("uid", "id", "v", F.inline("to"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    rows = rows.select("uid", "id", "v", "group", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    asked = placed.filter("is_query").withColumnRenamed("cell", "group").join(of, "group")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int"))
    # New columns: both sides come from one table.
    asked = asked.select(*[F.col(c).alias(c) for c in ("uid", "id", "v", "group", "chunk")], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    task = ["group", "chunk", "block"]
    found = asked.groupBy(*task).cogroup(rows.groupBy(*task)).applyInArrow(_solve(kind, k), FOUND)
    best = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "other")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def spread_pivots(drawn: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` different rows: the first, then always the one farthest from those chosen."""
    if not len(drawn):
        return drawn
    x = drawn.astype(np.float64)
    chosen, gap = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return drawn[chosen]
