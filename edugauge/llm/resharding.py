"""Resharding by minimum-cost flow.

The corpus lies in old shards; the new ones shall hold equal numbers of rows (at most one apart). Rows that need not move
stay. How many rows each old shard gives, and which new shard takes one row more, is a minimum-cost flow over blocks of
rows with a row's bytes as the cost of moving it. Within an old shard the smallest rows move first, so only one choice is
open for each: whether the row just below the ``base`` largest ones moves, ``base`` being the rows that every new shard
has at least. That row is a block of its own, priced by its real size; the smaller rows and the larger ones are the two other blocks. A
block's mean price does not fall with the rank, so the transfer moves the fewest bytes. The flow is solved on the
driver: three blocks a shard, whatever the corpus.

The plan is applied with ranks that need no window: the old layout is written once, in the order of shard, size and
id, one file a task, so a row's rank in its shard is its position in its file plus an offset of that file. Shards that
gain or lose rows are rewritten, all others are read from the files they have.

Defined cases: a null text has no bytes; size is bytes plus 1. Null ids sort first; rows with equal size and id are
dealt in any order, each once. With fewer rows than shards some stay empty. The columns of the table are kept, but for
those that the result writes. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edugauge.llm.common import keep_columns, parallelism, quoted
from edugauge.session import scratch_path


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials; integer capacities, costs of 0 or more."""

    def __init__(self) -> None:
        self.arcs: list[list] = []  # to, capacity left, cost; arc i ^ 1 is its reverse
        self.out: dict[object, list[int]] = defaultdict(list)

    def arc(self, tail, head, capacity: int, cost: int = 0) -> int:
        self.out[tail].append(len(self.arcs))
        self.arcs.append([head, capacity, cost])
        self.out[head].append(len(self.arcs))
        self.arcs.append([tail, 0, -cost])
        return len(self.arcs) - 2

    def sent(self, arc: int) -> int:
        return self.arcs[arc ^ 1][1]

    def run(self, source, sink) -> int:
        """Send as much as fits at the least cost; returns the cost."""
        height, cost = defaultdict(int), 0
        while True:
            near, came, heap, tie = {source: 0}, {}, [(0, 0, source)], 0
            while heap:
                d, _, node = heapq.heappop(heap)
                if d > near[node]:
                    continue
                for i in self.out[node]:
                    head, left, price = self.arcs[i]
                    reach = d + price + height[node] - height[head]
                    if left > 0 and reach < near.get(head, 1 << 62):
                        near[head], came[head], tie = reach, i, tie + 1
                        heapq.heappush(heap, (reach, tie, head))
            if sink not in near:
                return cost
            for node in self.out:
                height[node] += min(near.get(node, near[sink]), near[sink])
            path, node = [], sink
            while node != source:
                path.append(came[node])
                node = self.arcs[came[node] ^ 1][0]
            amount = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= amount
                self.arcs[i ^ 1][1] += amount
            cost += amount * (height[sink] - height[source])


def plan(blocks: dict[tuple[int, int], tuple[int, int]], new_shards: int) -> tuple[dict[int, int], dict[int, int]]:
    """From ``(old shard, block) -> (rows, bytes)``, blocks in ascending order of their rows' sizes: rows that leave each old shard, rows that each new one takes in."""
    total = sum(rows for rows, _ in blocks.values())
    base, more = divmod(total, new_shards)
    flow = Flow()
    leave, take = defaultdict(list), {}
    for (old, kind), (rows, size) in sorted(blocks.items()):
        flow.arc("source", ("block", old, kind), rows)
        if old < new_shards:
            flow.arc(("block", old, kind), ("new", old), rows)
        leave[old].append(flow.arc(("block", old, kind), "moved", rows, max(1, size // max(1, rows))))
    for new in range(new_shards):
        take[new] = flow.arc("moved", ("new", new), total)
        flow.arc(("new", new), "sink", base)
        flow.arc(("new", new), "more", 1)
    flow.arc("more", "sink", more)
    flow.run("source", "sink")
    return {old: sum(map(flow.sent, arcs)) for old, arcs in leave.items()}, {new: flow.sent(arc) for new, arc in take.items()}


def transfers(counts: dict[int, int], leaving: dict[int, int], taking: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """``(old, first rank, end rank, new, first slot)`` of each block: rows that stay fill the first slots of a shard."""
    out, slots, open_ = [], {}, [[new, n] for new, n in sorted(taking.items()) if n]
    for old, rows in sorted(counts.items()):
        if rows > leaving[old]:
            out.append((old, leaving[old], rows, old, 0))
            slots[old] = rows - leaving[old]
    for old, left in sorted(leaving.items()):
        at = 0
        while at < left:
            new, room = open_[0]
            n = min(room, left - at)
            out.append((old, at, at + n, new, slots.get(new, 0)))
            slots[new] = slots.get(new, 0) + n
            at += n
            open_[0][1] -= n
            if not open_[0][1]:
                open_.pop(0)
    return out


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def reshard(docs: DataFrame, old_shard: Column, new_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` plus ``shard`` and ``slot`` (from 0, without gaps), read from the rewritten shards.

    ``old_shard`` (0 and up) says where each row lies now.
    """
    spark = docs.sparkSession
    kept = keep_columns(docs, "shard", "slot")
    names = docs.select(*kept).columns
    placed = docs.select(*kept, old_shard.cast("int").alias("__llm_old"), size_of(quoted(text_col)).alias("__llm_size"))
    order = ["__llm_old", "__llm_size", quoted(id_col)]
    path = scratch_path(spark, "old_shards")
    placed.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)
    old = spark.read.schema(placed.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("__llm_file"), F.col("_metadata.row_index").alias("__llm_row"))

    # a file holds few shards, as rows are sorted
    found = old.groupBy("__llm_file", "__llm_old").agg(F.min("__llm_row").alias("first"), F.count(F.lit(1)).alias("rows")).collect()
    counts, offsets = defaultdict(int), []
    for r in sorted(found, key=lambda r: (r["__llm_old"], int(r["__llm_file"].split("-")[1]), r["__llm_file"])):
        offsets.append((r["__llm_file"], r["__llm_old"], counts[r["__llm_old"]] - r["first"]))
        counts[r["__llm_old"]] += r["rows"]

    # this table and that of the moves grow with files and shards only
    offset = F.broadcast(spark.createDataFrame(offsets, "__llm_file string, __llm_old int, __llm_offset long"))
    ranked = old.join(offset, ["__llm_file", "__llm_old"]).withColumn("__llm_rank", F.col("__llm_row") + F.col("__llm_offset"))
    edge = F.broadcast(spark.createDataFrame([(o, n - sum(counts.values()) // new_shards - 1) for o, n in counts.items()], "__llm_old int, __llm_edge long"))
    block = F.signum(F.col("__llm_rank") - F.col("__llm_edge")).cast("int")
    sums = ranked.join(edge, "__llm_old").groupBy("__llm_old", block.alias("block")).agg(F.count(F.lit(1)).alias("rows"), F.sum("__llm_size").alias("bytes"))
    blocks = {(r["__llm_old"], r["block"]): (r["rows"], r["bytes"]) for r in sums.collect()}
    leaving, taking = plan(blocks, new_shards) if blocks else ({}, {})
    moves = transfers(counts, leaving, taking)

    move = F.broadcast(spark.createDataFrame(moves, "__llm_old int, __llm_from long, __llm_to long, shard int, __llm_slot long"))
    dealt = ranked.join(move, "__llm_old").filter("__llm_rank >= __llm_from and __llm_rank < __llm_to")
    dealt = dealt.select(*(quoted(n) for n in names), (F.col("__llm_slot") + F.col("__llm_rank") - F.col("__llm_from")).alias("slot"), "shard")
    changed = sorted({shard for shard, n in leaving.items() if n and shard < new_shards} | {shard for shard, n in taking.items() if n})
    target = scratch_path(spark, "new_shards")
    dealt.filter(F.col("shard").isin(changed)).write.partitionBy("shard").option("compression", "zstd").parquet(target)
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    rewritten = spark.read.schema(schema).parquet(target)
    return rewritten.unionByName(dealt.filter(~F.col("shard").isin(changed))) if len(changed) < new_shards else rewritten
