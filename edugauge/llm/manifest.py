"""Merkle manifest of a table: a hash tree over its rows, with the proof of every row, by butterfly exchange.

Rows of a group (a language) are leaves in ascending order of their ids. Every ``fanout`` consecutive nodes become their hash
until one node remains, the group's root; the roots of the groups become the root of the table in the same way. A proof is
what a row needs to get from its leaf to the root: the other nodes of its run, level by level.

Leaves are ranked by a sort into ranges and counts by range, and dealt into aligned blocks of ``fanout ** block_levels`` leaves. A
block hashes its own subtree. Then blocks swap roots in rounds: in round r, those meet whose numbers differ in digit r (to base
``fanout``) only. Each of the at most ``fanout`` members gets the roots of all, so each of them hashes the ancestor by itself and notes
the siblings of its own path. The last run of a level may hold a smaller subtree; its blocks stand in for its missing ones.
After the last round every block knows the root and its own upper proof: nothing is sent down the tree. Digests alone are
shuffled, never texts, and no step needs more than ``fanout`` roots or the leaves of one block together.

Defined cases: a null field is hashed as ``-``; a null group comes first, a null id before all others. Equal ids are ordered
by their leaves, and rows that are equal in all fields have equal leaves at places of their own. Texts of any length are hashed whole. An
empty table gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import broadcast_if_small, map_arrow, parallelism, quoted, ship, store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, BLOCK_LEVELS = 8, 4
#: Leaves of a range when they are ranked, about.
RANGE_ROWS = 1 << 17

PLACES = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("size", T.IntegerType())]))


def digest(text: Column) -> Column:
    """Lower-case hex sha256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 length, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _ranked(leaves: DataFrame, rows: int) -> DataFrame:
    """``leaves`` (``grp, item, leaf, claim``) with ``rank`` in the group and the group's ``total``."""
    spark = leaves.sparkSession
    # Equal leaves may change places, so the row number only spreads them over ranges.
    keys = ["grp", "item", "leaf", "spread"]
    parts = max(parallelism(spark), -(-rows // RANGE_ROWS))
    spread = leaves.withColumn("spread", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("spread")
    at = store(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")  # range number and row in it
    at = at.withColumns({"range": F.shiftright("at", 33), "row": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("at")
    counts = at.groupBy("grp", "range").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy("grp").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("grp").alias("_grp"), F.col("range").alias("_range"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"),
    )  # a row for each range, and one more for each group that starts within a range
    counts = broadcast_if_small(store(counts, "ranges"), 100)
    joined = at.join(counts, (F.col("range") == F.col("_range")) & F.col("grp").eqNullSafe(F.col("_grp")))
    return joined.select("grp", "item", "leaf", "claim", (F.col("row") + F.col("offset")).alias("rank"), "total")


def _levels(nodes: list[bytes], fanout: int, levels: int, single: bool) -> list[list[bytes]]:
    """Levels of the tree over ``nodes`` (hex digests): up to one node if it is the whole tree, else exactly so many."""
    out = [nodes]
    while len(out[-1]) > 1 if single else len(out) <= levels:
        last = out[-1]
        out.append([hashlib.sha256(b"".join(last[i : i + fanout])).hexdigest().encode() for i in range(0, len(last), fanout)])
    return out


def _hexes(packed: bytes) -> list[bytes]:
    text = packed.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _block(fanout: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        leaves = b"".join(rows["leaf"].to_pylist())
        claims = b"".join(rows["claim"].to_pylist())
        number, total = rows["block"][0].as_py(), rows["total"][0].as_py()
        node = _levels(_hexes(leaves), fanout, levels, total <= fanout**levels)[-1][0].decode()
        item = rows["item"].combine_chunks()
        items = pa.ListArray.from_arrays(pa.array([0, len(item)], pa.int32()), item)
        columns = [rows["grp"].slice(0, 1), pa.array([number]), pa.array([total]), items, pa.array([leaves], pa.binary()), pa.array([claims], pa.binary()), pa.array([node])]
        return pa.table(columns, names=["grp", "block", "total", "items", "leaves", "claims", "node"])

    return block


def _swap(blocks: DataFrame, fanout: int, width: int, many: Column) -> DataFrame:
    """One round: blocks whose numbers differ in one digit swap roots; ``width`` is the weight of the digit."""
    n, up = F.col("blocks"), width * fanout
    child, parent = F.floor(F.col("block") / width), F.floor(F.col("block") / up)
    slot, size = F.col("block") % width, F.least(F.lit(width), n - child * width)
    # A smaller last subtree stands in at every place where a larger sibling has a block.
    last = F.when(child > parent * fanout, F.lit(width - 1)).otherwise(size - 1)
    sent = blocks.filter(many).select("grp", "block", "blocks", "node", "proof", "places", child.alias("child"), parent.alias("parent"), slot.alias("own"), F.explode(F.sequence(slot, last, size)).alias("slot"))
    own = F.col("own") == F.col("slot")
    member = F.struct("child", "node", *[F.when(own, F.col(c)).alias(c) for c in ("block", "blocks", "proof", "places")])
    met = sent.groupBy("grp", "parent", "slot").agg(F.sort_array(F.collect_list(member)).alias("members"))  # ``fanout`` at most
    nodes = F.transform("members", lambda m: m["node"])
    met = met.select("grp", F.posexplode("members").alias("at", "me"), nodes.alias("nodes")).filter("me.block is not null")
    others = F.concat(F.slice("nodes", F.lit(1), F.col("at")), F.slice("nodes", F.col("at") + 2, F.lit(fanout)))
    place = F.struct(F.col("at").alias("at"), F.size("nodes").alias("size"))
    return met.select(
        "grp", "me.block", "me.blocks", digest(F.array_join("nodes", "")).alias("node"),
        F.concat("me.proof", F.array_join(others, "")).alias("proof"), F.concat("me.places", F.array(place)).cast(PLACES).alias("places"),
    )


def _butterfly(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``grp, block, node, proof, places``: the root of the group and the way to it, for every block."""
    number = F.ceil(F.col("total") / fanout**levels)
    state = blocks.select("grp", "block", number.alias("blocks"), "node", F.lit("").alias("proof"), F.array().cast(PLACES).alias("places"))
    most, width = state.agg(F.max("blocks")).first()[0] or 0, 1
    while width < most:
        many = F.col("blocks") > width
        state = store(_swap(state, fanout, width, many).unionByName(state.filter(~many)), "swapped")
        width *= fanout
    return state.drop("blocks")


def _prove(fanout: int, levels: int):
    """Leaves of a block with their whole proofs."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i] for name in batch.schema.names}
                packed = row["leaves"].as_py()
                tree = _levels(_hexes(packed), fanout, levels, row["total"].as_py() <= fanout**levels)
                upper, places = row["_proof"].as_py().encode(), [(p["at"], p["size"]) for p in row["_places"].as_py()]
                ways = [(upper, places)]  # of the nodes of a level, from the top of the block down
                for nodes in reversed(tree[:-1]):
                    below = []
                    for parent, (proof, where) in enumerate(ways):
                        run = b"".join(nodes[parent * fanout : (parent + 1) * fanout])
                        size = len(run) // 64
                        below += [(run[: 64 * at] + run[64 * (at + 1) :] + proof, [(at, size), *where]) for at in range(size)]
                    ways = below
                claims, items = row["claims"].as_py(), row["items"].values
                for start in range(0, len(ways), 1024):
                    part = ways[start : start + 1024]
                    ends = np.cumsum([0, *(len(where) for _, where in part)])
                    at, size = (np.array([place[j] for _, where in part for place in where], np.int32) for j in (0, 1))
                    pairs = pa.StructArray.from_arrays([pa.array(at), pa.array(size)], names=["at", "size"])
                    digests = [[b[32 * j : 32 * j + 32].hex() for j in range(start, start + len(part))] for b in (packed, claims)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            items.slice(start, len(part)), *(pa.array(d, pa.string()) for d in digests),
                            *(pa.array([row[name].as_py()] * len(part), pa.string()) for name in ("_subroot", "_root")),
                            pa.array([proof.decode() for proof, _ in part], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                        ],
                        names=["item", "leaf", "claim", "subroot", "root", "proof", "places"],
                    )

    return prove


def _trees(leaves: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The blocks of all trees, and for every block the root of its tree with the way to it."""
    ship(leaves.sparkSession)
    ranked = _ranked(leaves, leaves.count()).withColumn("block", F.floor(F.col("rank") / fanout**levels))
    item = leaves.schema["item"].dataType.simpleString()
    kind = f"grp string, block long, total long, items array<{item}>, leaves binary, claims binary, node string"
    blocks = store(ranked.groupBy("grp", "block").applyInArrow(_block(fanout, levels), kind), "blocks")
    return blocks, _butterfly(blocks, fanout, levels)


def _proofs(blocks: DataFrame, ways: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for each leaf; ``ways`` has ``grp, block, subroot, root, proof, places``."""
    ways = ways.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "subroot", "root", "proof", "places")
    ways = broadcast_if_small(store(ways, "ways"), 8192)
    joined = blocks.join(ways, (F.col("block") == F.col("_block")) & F.col("grp").eqNullSafe(F.col("_grp")))
    schema = T.StructType(
        [
            T.StructField("item", blocks.schema["items"].dataType.elementType),
            *(T.StructField(name, T.StringType()) for name in ("leaf", "claim", "subroot", "root", "proof")), T.StructField("places", PLACES),
        ]
    )
    ways = [F.col(c).alias(f"_{c}") for c in ("subroot", "root", "proof", "places")]
    return map_arrow(joined.select("total", "items", "leaves", "claims", *ways), _prove(fanout, levels), schema)


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", claim: Column | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """``doc_id, leaf, claim, subroot, root, proof, places`` of every row.

    ``proof`` is the hex digests of the siblings one after the other, from the leaf up; ``places`` tells for each level the row's
    place in its run and the size of the run. ``claim`` is another digest of the same row, such as that of a received copy, which is
    carried along for :func:`folded`; by default the leaf itself.
    """
    own = leaf([quoted(c) for c in fields])
    claimed = own if claim is None else claim
    item = quoted(order).cast("long")
    rows = docs.select(quoted(group).cast("string").alias("grp"), item.alias("item"), F.unhex(own).alias("leaf"), F.unhex(claimed).alias("claim"))
    blocks, ways = _trees(store(rows, "leaves"), fanout, block_levels)

    # The roots of the groups are the leaves of one more tree.
    roots = ways.filter("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("item"), F.unhex("node").alias("leaf"), F.unhex("node").alias("claim"))
    top_blocks, top = _trees(store(roots, "roots"), fanout, block_levels)
    top = top.select("grp", "block", F.col("node").alias("subroot"), F.col("node").alias("root"), "proof", "places")
    tops = _proofs(top_blocks, top, fanout, block_levels).select(F.col("item").alias("_grp"), "root", F.col("proof").alias("_proof"), F.col("places").alias("_places"))
    tops = broadcast_if_small(store(tops, "tops"), 4096)
    whole = ways.join(tops, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "grp", "block", F.col("node").alias("subroot"), "root", F.concat("proof", "_proof").alias("proof"), F.concat("places", "_places").alias("places")
    )
    return _proofs(blocks, whole, fanout, block_levels).withColumnRenamed("item", "doc_id")


def folded(digest_col: str = "leaf", proof: str = "proof", places: str = "places") -> Column:
    """The root that a digest and a proof lead to."""
    start = F.struct(F.col(digest_col).alias("h"), F.lit(0).alias("done"))

    def up(state: Column, place: Column) -> Column:
        def piece(first: Column, n: Column) -> Column:
            return F.substr(F.col(proof), first * 64 + 1, n * 64)

        at, others = place["at"], place["size"] - 1
        run = F.concat(piece(state["done"], at), state["h"], piece(state["done"] + at, others - at))
        return F.struct(digest(run).alias("h"), (state["done"] + others).alias("done"))

    return F.aggregate(places, start, up)["h"]
