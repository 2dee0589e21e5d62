"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each partition of the corpus sorts the short fingerprints of its texts, cuts them by owner (the top bits) and sends
each owner one Golomb-Rice coded message. An owner decodes its messages, finds the fingerprints that occur in more
than one, and answers each message with a bitmap. Only rows whose bit is set (or whose fingerprint repeats inside
their own partition) are suspects; only suspect texts are shuffled, and grouping them by the whole text compares
every byte. The fingerprint is as wide as log2(rows) + ``SPARE_BITS``, so a fixed small share of rows is suspected in vain at
every corpus size.

Defined cases: a null text is the empty text. Ids may be null (smaller than any id) or repeat: exactly one row of a
group stays, and among rows with the same largest id it is an arbitrary one. No input column but id and text is read;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.llm.common import ascii_lower, broadcast_if_small, id_and_text, keep_columns, parallelism, quoted, ship, store

#: Width of a fingerprint beyond log2(rows): about one row in 2**12 is suspected in vain.
SPARE_BITS = 12
#: Rows that one message set covers; a longer partition sends several.
PART_ROWS = 1 << 20
#: Fingerprints that an owner has to hold, about.
OWNER_ROWS = 4 << 20

MESSAGE = "part long, owner int, n int, k int, unary binary, rest binary, runs array<int>, ids array<long>, shas array<string>"
ROW = "doc_id long, uid long, fp long, sha string, suspect boolean"


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Golomb-Rice code of rising unsigned integers: parameter k, the unary quotients and the k-bit remainders."""
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, 0.69 * float(values[-1]) / len(values)))))
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def rice_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    """Inverse of :func:`rice_encode` for ``n`` values."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k).astype(np.uint64)
        gaps += bits @ (np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64)


def _messages(part: int, table: pa.Table, owner_shift: int) -> pa.RecordBatch:
    fps = table["fp"].to_numpy().astype(np.uint64)
    order = np.argsort(fps, kind="stable")
    fps = fps[order]
    ids, shas = (table[name].combine_chunks().take(pa.array(order)) for name in ("_id", "sha"))
    values, starts, runs = np.unique(fps, return_index=True, return_counts=True)
    owners = (values >> np.uint64(owner_shift)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(owners, prepend=-1))
    out = {name: [] for name in ("part", "owner", "n", "k", "unary", "rest", "runs")}
    offsets = [0]
    for low, high in zip(cuts, [*cuts[1:], len(values)]):
        owner = int(owners[low])
        k, unary, rest = rice_encode(values[low:high] - np.uint64(owner << owner_shift))
        for name, value in zip(out, (part, owner, high - low, k, unary, rest, runs[low:high].tolist())):
            out[name].append(value)
        offsets.append(int(starts[high]) if high < len(values) else len(fps))
    at = pa.array(offsets, pa.int32())
    kinds = {"part": pa.int64(), "owner": pa.int32(), "n": pa.int32(), "k": pa.int32(), "unary": pa.binary(), "rest": pa.binary(), "runs": pa.list_(pa.int32())}
    columns = {name: pa.array(values, kinds[name]) for name, values in out.items()}
    columns |= {"ids": pa.ListArray.from_arrays(at, ids), "shas": pa.ListArray.from_arrays(at, shas)}
    return pa.RecordBatch.from_pydict(columns)


def _pack(owner_shift: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, rows = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PART_ROWS:
                yield _messages((task << 16) + number, pa.Table.from_batches(held), owner_shift)
                number, held, rows = number + 1, [], 0
        if rows:
            yield _messages((task << 16) + number, pa.Table.from_batches(held), owner_shift)

    return pack


def _answer(messages: pa.Table) -> pa.Table:
    """One owner: which of the values in each message occur in another message too."""
    rows = messages.to_pylist()
    values = [rice_decode(r["n"], r["k"], r["unary"], r["rest"]) for r in rows]
    seen, counts = np.unique(np.concatenate(values), return_counts=True)
    repeated = seen[counts > 1]
    bitmaps = [np.packbits(np.isin(v, repeated, assume_unique=True)).tobytes() for v in values]
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int64()), "owner": pa.array([r["owner"] for r in rows], pa.int32()), "bitmap": pa.array(bitmaps, pa.binary())})


def _unpack(owner_shift: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i] for name in batch.schema.names}
                part, owner, n = (row[name].as_py() for name in ("part", "owner", "n"))
                values = rice_decode(n, row["k"].as_py(), row["unary"].as_py(), row["rest"].as_py()) + np.uint64(owner << owner_shift)
                runs = row["runs"].values.to_numpy()
                bits = np.unpackbits(np.frombuffer(row["bitmap"].as_py(), np.uint8))[:n].astype(bool)
                rows = int(runs.sum())
                uid = np.arange(rows, dtype=np.int64) + (part << 22)  # unique among rows of one owner
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, pa.array(uid), pa.array(np.repeat(values, runs).astype(np.int64)), row["shas"].values, pa.array(np.repeat(bits | (runs > 1), runs))],
                    names=["doc_id", "uid", "fp", "sha", "suspect"],
                )

    return unpack


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=ascii_lower) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256, fp``.

    ``normalise`` maps the text column to what has to be equal, by default A-Z in lower case. The row with the largest
    id of a group is kept.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.count()
    bits = min(62, max(1, rows).bit_length() + SPARE_BITS)
    owners = max(parallelism(spark), -(-rows // OWNER_ROWS))
    owner_bits = min(bits, (owners - 1).bit_length())
    shift = bits - owner_bits

    plain = id_and_text(docs, id_col, text_col).select("_id", normalise(F.col("_text")).alias("_norm"))
    keyed = plain.select("_id", "_norm", F.shiftrightunsigned(F.xxhash64("_norm"), 64 - bits).alias("fp"))
    narrow = keyed.select("_id", "fp", F.sha2(F.col("_norm").cast("binary"), 256).alias("sha"))
    sent = store(narrow.mapInArrow(_pack(shift), MESSAGE), "fingerprints")
    answers = sent.select("part", "owner", "n", "k", "unary", "rest").groupBy("owner").applyInArrow(_answer, "part long, owner int, bitmap binary")
    told = store(sent.join(answers, ["part", "owner"]).mapInArrow(_unpack(shift), ROW), "suspects")

    suspects = told.filter("suspect")
    doubtful = broadcast_if_small(store(suspects.select(F.col("doc_id").alias("__llm_id")).distinct(), "doubtful"), 16)
    # equal bytes meet in one group; copies are folded before the shuffle
    texts = id_and_text(docs, id_col, text_col).join(doubtful, F.col("_id").eqNullSafe(F.col("__llm_id")), "left_semi")
    texts = texts.select("_id", normalise(F.col("_text")).alias("_norm"))
    verified = texts.groupBy("_norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("_id").alias("keep_id"))
    verified = verified.filter("group_size > 1").select(F.sha2(F.col("_norm").cast("binary"), 256).alias("sha"), "group_size", "keep_id")
    chosen = suspects.groupBy("sha").agg(F.max_by("uid", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("keep_uid"))
    groups = store(verified.join(chosen, "sha"), "groups")
    joined = suspects.join(broadcast_if_small(groups, 160), "sha", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("keep_uid"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"), "fp",
    )
    alone = told.filter("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "fp"
    )
    return alone.unionByName(joined)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=ascii_lower) -> DataFrame:
    """The kept rows of ``docs`` with all their columns.

    A row is dropped if its text equals that of a kept row and it is not that row. Rows that repeat with the same id
    and an equal text leave one row.
    """
    decided = store(mark(docs, id_col, text_col, normalise), "decisions")
    groups = decided.filter("group_size > 1").select(F.col("text_sha256").alias("__llm_sha"), F.col("keep_id").alias("__llm_keep")).distinct()
    groups = broadcast_if_small(store(groups, "kept"), 100)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    hashed = docs.withColumn("__llm_sha", F.sha2(normalise(text).cast("binary"), 256))
    joined = hashed.join(groups.withColumn("__llm_member", F.lit(True)), "__llm_sha", "left")
    single = joined.filter(F.col("__llm_member").isNull()).select(*keep_columns(docs))
    stays = joined.filter(F.col("__llm_member") & quoted(id_col).cast("long").eqNullSafe(F.col("__llm_keep")))
    return single.unionByName(stays.dropDuplicates(["__llm_sha"]).select(*keep_columns(docs)))

