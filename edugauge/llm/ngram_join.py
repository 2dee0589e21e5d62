"""Jaccard self-join of word shingle sets with filters under several global token orders.

A pair with similarity t shares, under any global order of all tokens, a token among the first
n - ceil(t * n) + 1 of each set (n its size): its prefix. Candidates must share prefix tokens under every one of several orders:

A. The tokens of a part of the hash range first, rarest first by their exact number of sets, then the others by hash; the part
   depends on the class of the set's size, and a set joins both classes where its partners may be in the next one. This
   order is applied by Spark over all documents: only that part of the tokens is shuffled. Nearly all
   sets have enough tokens of their own in it to fill their prefix, and have no partner. The others (the survivors) are grouped by the
   connected components of shared prefix tokens: two sets of different groups cannot be a pair.
B, C. Two more orders by reseeded hashes, applied to the survivors' whole sets within a group.

Pairs that pass all orders and the length filter are verified by exact intersection sizes. Large groups are cut into blocks
that meet in pairs, so no task holds more than two blocks, and of verified pairs only a spanning forest of
each task and the number of links of each set are passed on. Equal sets are one set with several members from the start.

Tokens and sets are known by 64-bit hashes (order A goes by 48 bits of its tokens); that two of a corpus' sets collide has a chance of about n^2 / 2^65.

Defined cases: a null text, or one without words, has the empty set: no links, its own id as component. With fewer words
than a shingle has, the whole sequence is one shingle. Null ids never name a component unless all of its ids are null. Rows that repeat an
id with equal sets count as members like any others. Only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.llm.common import broadcast_if_small, id_and_text, keep_columns, quoted, ship, slices, store
from edugauge.llm.components import components

BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Size classes of order A: smallest size, and the part of the hash range as a multiple of 1 - t. A prefix is (1 - t) of a set; small
#: sets need a larger part for enough tokens of their own. The result is the same for any classes.
CLASSES = ((1, 6.0), (64, 3.0), (256, 2.25))
#: Bits of a token that order A drops: its tokens are shuffled twice, and zero bytes cost little. Any map of tokens to ordered values
#: gives a valid order, so tokens that fall together only let a few more sets through to the checks of the whole sets.
DROPPED = np.uint64(16)
#: Sets of a block; a task holds two blocks.
BLOCK = 512
#: Columns of a dense piece of the token matrix.
PIECE = 4096

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, n.bit_length())
    if size not in _powers:
        up, down = np.full(size, BASE), np.full(size, INVERSE)
        up[0] = down[0] = 1
        _powers[size] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers[size]


def tokens_of(text: str, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lower = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    up, down = _tables(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    width = min(shingle, len(words))
    count = len(words) - width + 1
    h = np.full(count, width, np.uint64)
    for i in range(width):
        h = _mix(h * BASE + words[i : i + count])
    return np.unique(h)


def prefix_size(n: int, num: int, den: int) -> int:
    """Tokens of a set of ``n`` of which a partner shares one: n - ceil(num / den * n) + 1."""
    return n - -(-num * n // den) + 1


def universes(n: int, num: int, den: int) -> list[int]:
    """Size classes whose order A a set of ``n`` tokens takes part in: its own, and each larger one that a partner may lie in."""
    own = sum(n >= least for least, _ in CLASSES) - 1
    return [c for c in range(own, len(CLASSES)) if c == own or n * den >= num * CLASSES[c][0]]


def _signatures(shingle: int, num: int, den: int):
    limits = [np.uint64(min(2**64 - 1, int(times * (1 - num / den) * 2.0**64))) for _, times in CLASSES]
    dropped = DROPPED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [tokens_of(t.as_py(), shingle) for t in batch["_text"]]
            ids, units = [], []
            for tokens in sets:
                need = prefix_size(len(tokens), num, den) if len(tokens) else 0
                ids.append(_set_id(tokens))
                units.append([])
                for c in universes(len(tokens), num, den) if len(tokens) else []:
                    size = max(need, int(np.searchsorted(tokens, limits[c], "right")))  # the hash order goes on where the part ends
                    units[-1].append({"excess": size - need, "tokens": (_mix(tokens[:size] ^ np.uint64(c)) >> dropped).view(np.int64)})
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["_id"], "n": pa.array([len(s) for s in sets], pa.int32()), "set_id": pa.array(ids, pa.int64()),
                "units": pa.array(units, pa.list_(pa.struct([("excess", pa.int32()), ("tokens", pa.list_(pa.int64()))]))),
            })

    return run


def _set_id(tokens: np.ndarray) -> int:
    return int(_mix(np.array([np.sum(_mix(tokens * SEEDS[0])) + np.uint64(len(tokens))])).view(np.int64)[0])


def _whole_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [tokens_of(t.as_py(), shingle) for t in batch["_text"]]
            ids = [_set_id(s) for s in sets]
            yield pa.RecordBatch.from_pydict({"set_id": pa.array(ids, pa.int64()), "tokens": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return run


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of tokens that each two lists share."""
    out = np.zeros((len(lists), len(lists)), np.float32)
    if not lists:
        return out
    flat = np.concatenate(lists)
    values, place, met = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(met > 1) - 1  # a token of one list is shared by none
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    shared = met[place] > 1
    owner, column = owner[shared], number[place[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int((met > 1).sum()), PIECE):
        inside = slice(*np.searchsorted(column, [low, low + PIECE]))
        piece = np.zeros((len(lists), PIECE), np.float32)
        piece[owner[inside], column[inside] - low] = 1
        out += piece @ piece.T
    return out


def _verify(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist() if table.num_rows else []
        rows.sort(key=lambda r: r["set_id"])
        cross = rows[0]["low"] != rows[0]["high"]
        size = np.array([r["n"] for r in rows])
        home = np.array([r["block"] for r in rows])
        passed = np.triu(_common([np.array(r["prefix"], np.int64) for r in rows]) > 0, 1)
        passed &= size[:, None] * den >= num * size[None, :]
        passed &= size[None, :] * den >= num * size[:, None]
        if cross:
            passed &= home[:, None] != home[None, :]
        sets = [np.array(r["tokens"], np.int64).view(np.uint64) for r in rows]
        for seed in SEEDS:
            left = np.flatnonzero(passed.any(0) | passed.any(1))
            prefixes = [s[np.argsort(_mix(s ^ seed), kind="stable")[: prefix_size(len(s), num, den)]] for s in (sets[i] for i in left)]
            passed[np.ix_(left, left)] &= _common(prefixes) > 0
        left = np.flatnonzero(passed.any(0) | passed.any(1))
        both = _common([sets[i] for i in left]).astype(np.int64)
        union = size[left][:, None] + size[left][None, :] - both
        linked = passed[np.ix_(left, left)] & (den * both >= num * union)
        linked |= linked.T
        weight = np.array([r["members"] for r in rows], np.int64)[left]
        links = linked @ weight
        root = np.arange(len(left))
        while True:  # the smallest row reachable within this task
            least = np.where(linked, root[None, :], len(left)).min(1, initial=len(left))
            following = np.minimum(root, least)
            following = following[following]
            if (following == root).all():
                break
            root = following
        ids = np.array([r["set_id"] for r in rows], np.int64)[left]
        found = np.flatnonzero(links)
        return pa.table({"a": pa.array(ids[found]), "b": pa.array(ids[root[found]]), "links": pa.array(links[found].astype(np.int64))})

    return run


def link(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (smallest id reachable by links) and ``n_links`` (rows it links with).

    Two rows link if ``den * intersection >= num * union`` of their shingle sets.
    """
    ship(docs.sparkSession)
    plain = id_and_text(docs, id_col, text_col)
    signed = store(plain.mapInArrow(_signatures(shingle, num, den), "doc_id long, n int, set_id long, units array<struct<excess int, tokens array<long>>>"), "signatures")

    classes = signed.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("n").alias("n"))
    classes = store(classes, "classes")
    copied = store(classes.filter("members > 1").select("set_id", "rep", "members"), "copied")
    one_each = signed.filter("n > 0").select("doc_id", "set_id", "units").join(broadcast_if_small(copied.select("set_id", "rep"), 32), "set_id", "left")
    one_each = one_each.filter("rep is null or doc_id <=> rep").select("set_id", F.posexplode("units").alias("unit", "at"))

    # order A: exact numbers of sets for the tokens of the part
    rows = one_each.select("set_id", "unit", F.explode("at.tokens").alias("token"))
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    owned = rows.join(shared, "token").groupBy("set_id", "unit").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    owned = owned.join(one_each.select("set_id", "unit", "at.excess").distinct(), ["set_id", "unit"]).filter(F.size("shared") > F.col("excess"))
    prefix = F.slice(F.sort_array("shared"), F.lit(1), F.size("shared") - F.col("excess"))
    survivors = owned.groupBy("set_id").agg(F.flatten(F.collect_list(F.transform(prefix, lambda x: x["token"]))).alias("prefix"))
    survivors = store(survivors, "survivors")
    held = survivors.select("set_id", F.explode("prefix").alias("token"))
    least = held.groupBy("token").agg(F.min("set_id").alias("least"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    stars = held.join(least, "token").select(F.col("set_id").alias("a"), F.col("least").alias("b"))
    groups = store(components(stars), "groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    grouped = groups.withColumnRenamed("node", "set_id").join(sizes, "component").join(survivors, "set_id").join(classes, "set_id")
    grouped = store(grouped, "grouped")

    # the whole sets of the survivors, from one document each
    wanted = store(grouped.select(F.col("rep").alias("_id")).distinct(), "wanted")
    again = plain.join(broadcast_if_small(wanted, 16), plain["_id"].eqNullSafe(wanted["_id"]), "left_semi")
    sets = again.mapInArrow(_whole_sets(shingle), "set_id long, tokens array<long>").dropDuplicates(["set_id"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    dealt = grouped.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "set_id"), "blocks").cast("int")).join(sets, "set_id")
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "set_id", "n", "members", "prefix", "tokens")
    linked = met.groupBy("component", "low", "high").applyInArrow(_verify(num, den), "a long, b long, links long")
    linked = store(linked, "links")

    joined = components(linked.select("a", "b")).withColumnRenamed("node", "set_id")
    degree = linked.groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("others"))
    named = joined.join(classes.select("set_id", "rep"), "set_id")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("set_id", "component_id")
    told = copied.join(named, "set_id", "full").join(degree, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("others", F.lit(0)) + F.coalesce("members", F.lit(1)) - 1).alias("n_links")
    )
    told = broadcast_if_small(store(told, "told"), 32)
    marked = signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(told, "set_id", "left")
    own = F.col("set_id").isNull() | F.col("n_links").isNull()
    return marked.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component, with all columns: one of each group.

    Rows that repeat the id of a component stay together only if they are not linked; of linked ones with that id one stays.
    """
    found = store(link(docs, shingle, num, den, id_col, text_col), "linked")
    gone = found.filter("n_links > 0 and not (doc_id <=> component_id)").select(F.col("doc_id").alias("__llm_gone")).distinct()
    kept = docs.join(broadcast_if_small(store(gone, "gone"), 16), quoted(id_col).cast("long").eqNullSafe(F.col("__llm_gone")), "left_anti")
    twice = found.groupBy(F.col("doc_id").alias("__llm_id")).count().filter("count > 1").select("__llm_id")
    twice = broadcast_if_small(store(twice, "twice"), 16).withColumn("__llm_twice", F.lit(True))
    marked = kept.join(twice, quoted(id_col).cast("long").eqNullSafe(F.col("__llm_id")), "left")
    single = marked.filter(F.col("__llm_twice").isNull()).select(*keep_columns(docs))
    return single.unionByName(marked.filter("__llm_twice").dropDuplicates([id_col]).select(*keep_columns(docs)))
