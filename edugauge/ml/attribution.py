"""Additive (Shapley) attribution of a model score to its input variables.

A coalition takes some variables from the explained row and the rest from the background, which is
every row of the background table unless a sample is asked for. The Shapley value of a variable is
a fixed linear combination of the mean scores of the coalitions.

A forest is explained leaf by leaf. A row breaks the conditions on the way to a leaf in some of the
variables, which is a bit mask; a coalition of the row with a background row reaches the leaf if
neither breaks a condition in the variables it gives. So the weights of the background by leaf and
mask, counted in one pass, give the mean score of every coalition over all background rows.

A logistic model is explained in log-odds, where it is a sum over variables: the mean score of a coalition is the row's own terms
of its variables plus the background's mean terms of the others, so every order of the variables gives the same value, the row's
term minus the mean term. One aggregate over the background, one projection over the rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.ml import forest as grown
from edugauge.ml.features import Preprocessor
from edugauge.ml.models import Fitted
from edugauge.operators.sampling import seeded_sample
from edugauge.session import cut_lineage, scratch_path, ship_code

#: Variables whose coalitions are enumerated at most (two to that power); more have to ask for another method.
MOST_VARIABLES = 16


def exact_coefficients(n: int) -> dict[int, list[float]]:
    """Coalition mask -> coefficient of its mean score in the value of each variable."""
    table = {}
    for mask in range(1 << n):
        size = mask.bit_count()
        inside = factorial(size - 1) * factorial(n - size) / factorial(n) if size else 0.0
        outside = -factorial(size) * factorial(n - size - 1) / factorial(n) if size < n else 0.0
        table[mask] = [inside if mask >> i & 1 else outside for i in range(n)]
    return table


def sampled_coefficients(n: int, permutations: int, seed: int) -> dict[int, list[float]]:
    """The same table from seeded orders of the variables, each used forwards and backwards."""
    rng = random.Random(seed)
    table: dict[int, list[float]] = {}
    share = 1.0 / (2 * permutations)
    for _ in range(permutations):
        order = rng.sample(range(n), n)
        for walk in (order, order[::-1]):
            mask = 0
            for variable in walk:
                table.setdefault(mask, [0.0] * n)[variable] -= share
                mask |= 1 << variable
                table.setdefault(mask, [0.0] * n)[variable] += share
    return table


@dataclass
class Tree:
    """Nodes in pre-order, so that a parent comes before its children."""

    parent: list[int]
    is_left: list[bool]
    slot: list[int]
    split: list[float | tuple[float, ...]]
    value: list[float | None]

    def masks(self, features: np.ndarray, bits: Sequence[int]) -> Iterator[tuple[int, float, np.ndarray]]:
        """Per leaf its number, its score and each row's mask of variables that break a condition on the way to it."""
        broken: list[np.ndarray | None] = [np.zeros(len(features), np.int32)]
        left: dict[int, np.ndarray] = {}
        last = {p: i for i, p in enumerate(self.parent) if p >= 0}
        for i in range(len(self.parent)):
            p = self.parent[i]
            if p >= 0:
                broken.append(broken[p] | np.where(left[p] == self.is_left[i], 0, bits[self.slot[p]]).astype(np.int32))
                if last[p] == i:  # both children have their masks
                    broken[p] = left[p] = None
            if self.value[i] is None:
                column, split = features[:, self.slot[i]], self.split[i]
                left[i] = np.isin(column, split) if isinstance(split, tuple) else column <= split
            else:
                yield i, self.value[i], broken[i]
                broken[i] = None


def read_forest(fitted: Fitted, spark) -> list[Tree]:
    """The trees of a fitted forest, from its stored form; the model is on the driver anyway."""
    path = scratch_path(spark, "forest")
    fitted.model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas().sort_values(["treeID", "id"])
    trees = []
    for _, own in nodes.groupby("treeID", sort=True):
        own = own.reset_index(drop=True)
        parent, is_left = [-1] * len(own), [False] * len(own)
        slot, split, value = [], [], []
        for i, (l, r, s, stats) in enumerate(zip(own["leftChild"], own["rightChild"], own["split"], own["impurityStats"])):
            if l < 0:
                slot.append(-1), split.append(0.0), value.append(float(stats[1] / sum(stats)))
                continue
            parent[l], parent[r], is_left[l] = i, i, True
            listed = s["leftCategoriesOrThreshold"]
            slot.append(int(s["featureIndex"])), value.append(None)
            split.append(float(listed[0]) if s["numCategories"] < 0 else tuple(float(c) for c in listed))
        trees.append(Tree(parent, is_left, slot, split, value))
    return trees


def subset_sums(table: np.ndarray, n: int) -> np.ndarray:
    """For each mask of ``n`` bits (first axis) the sum over all its subsets."""
    shape = table.shape
    for i in range(n):
        halves = table.reshape(1 << n - i - 1, 2, 1 << i, -1)
        table = np.concatenate([halves[:, :1], halves[:, :1] + halves[:, 1:]], axis=1).reshape(shape)
    return table


def variable_bits(fitted: Fitted) -> list[int]:
    """For each slot of the feature vector the bit of its variable."""
    p = fitted.preprocessor
    return [1 << i for i, _ in enumerate(p.numeric)] + [1 << len(p.numeric) + i for i, c in enumerate(p.categorical) for _ in p.categories[c]]


def forest_sums(
    fitted: Fitted, rows: DataFrame, row_id: str, others: DataFrame, variables: Sequence[str], coefficients: dict[int, list[float]]
) -> DataFrame:
    """``row_id, _own, base, prediction, _phi0, ...`` of every row, against ``others`` with a share ``_w`` each.

    ``coefficients`` of coalitions that are not listed are 0.

    The background is never brought together: partitions count shares by leaf and mask. The explained
    rows are broadcast as one matrix, and each tree adds its part for all of them.
    """
    spark, n = rows.sparkSession, len(variables)
    ship_code(spark)
    trees, bits = read_forest(fitted, spark), variable_bits(fitted)
    forest = spark.sparkContext.broadcast(trees)

    def matrix(column: pd.Series) -> np.ndarray:
        return np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(bits)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            features, w = matrix(batch["f"]), batch["_w"].to_numpy()
            for t, tree in enumerate(forest.value):
                found = []
                for leaf, _, broken in tree.masks(features, bits):
                    sums = np.bincount(broken, w)
                    met = np.flatnonzero(sums)
                    found.append((np.full(len(met), leaf), met, sums[met]))
                leaf, mask, w_sum = (np.concatenate(x) for x in zip(*found))
                yield pd.DataFrame({"tree": t, "leaf": leaf, "mask": mask, "w": w_sum})

    vector = vector_to_array("features").alias("f")
    counted = fitted.preprocessor.transform(others).select(vector, "_w").mapInPandas(count, "tree int, leaf int, mask int, w double")
    counted = counted.groupBy("tree", "leaf", "mask").agg(F.sum("w").alias("w"))
    own = cut_lineage(rows.select(F.col(row_id).alias("row_id"), *variables))
    listed = fitted.preprocessor.transform(own).select("row_id", vector).toPandas()
    explained = spark.sparkContext.broadcast((listed["row_id"].to_numpy(), matrix(listed["f"])))
    full = (1 << n) - 1
    table = np.zeros((full + 1, n))
    for mask, values in coefficients.items():
        table[mask] = values

    def add(part: pd.DataFrame) -> pd.DataFrame:
        ids, features = explained.value
        t = int(part["tree"].iloc[0])
        by_leaf = {leaf: (g["mask"].to_numpy(), g["w"].to_numpy()) for leaf, g in part.groupby("leaf")}
        out = np.zeros((len(ids), n + 2))
        for leaf, value, broken in forest.value[t].masks(features, bits):
            share = np.zeros(1 << n)
            mask, w = by_leaf[leaf]
            share[mask] = w
            share = subset_sums(share, n)  # by coalition: share of the background that the row's variables have to be right for
            # By the mask that a row breaks: the sums over the coalitions without any of its variables.
            phi = subset_sums(table * share[:, None], n)[full - broken]
            out[:, 0] += value * share[0]
            out[:, 1] += value * np.where(broken == 0, share[full], 0.0)
            out[:, 2:] += value * phi
        out /= len(forest.value)
        return pd.DataFrame({"row_id": ids, "base": out[:, 0], "prediction": out[:, 1], **{f"_phi{i}": out[:, 2 + i] for i in range(n)}})

    names = ["base", "prediction", *(f"_phi{i}" for i in range(n))]
    schema = f"row_id {own.schema['row_id'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in names)
    sums = counted.groupBy("tree").applyInPandas(add, schema).groupBy("row_id").agg(*[F.sum(c).alias(c) for c in names])
    return sums.join(own.select("row_id", F.struct(*variables).alias("_own")), "row_id")


#: Explained or background rows whose masks are held at a time.
MASK_ROWS = 1 << 15


def leaf_masks(tree: grown.Tree, codes: np.ndarray, bits: Sequence[int]) -> Iterator[tuple[float, int, np.ndarray]]:
    """Per leaf its score, the mask of the variables on the way to it, and each row's mask of those that break a condition (``codes`` by slot and row)."""
    leaves, below = tree.leaves, [(0, 0, np.zeros(codes.shape[1], np.int16))]
    while below:
        node, path, broken = below.pop()
        if leaves[node]:
            yield float(tree.value[node]), path, broken
            continue
        slot, left = tree.slot[node], int(tree.left[node])
        bit = np.int16(bits[slot])
        goes = codes[slot] <= tree.bin[node]
        below.append((left + 1, path | int(bit), broken | goes * bit))
        below.append((left, path | int(bit), broken | ~goes * bit))


def submasks(mask: int) -> np.ndarray:
    """All masks within ``mask``, in the order of its own bits."""
    found = np.zeros(1, np.int64)
    for i in range(mask.bit_length()):
        if mask >> i & 1:
            found = np.concatenate([found, found | 1 << i])
    return found


def tree_sums(tree: grown.Tree, explained: np.ndarray, background: np.ndarray, shares: np.ndarray, bits: Sequence[int], table: np.ndarray) -> np.ndarray:
    """``base, prediction, phi...`` of every explained row by one tree (rows as bins by slot and row).

    A leaf depends on the variables on its way only, so its coalitions are those of them; a coalition of others counts with the one of
    them that it contains.
    """
    n = table.shape[1]
    weights: list[np.ndarray] = []  # by leaf: the background's shares by mask of broken variables
    for start in range(0, background.shape[1], MASK_ROWS):
        part = slice(start, start + MASK_ROWS)
        for i, (_, path, broken) in enumerate(leaf_masks(tree, background[:, part], bits)):
            met = np.bincount(broken, shares[part], path + 1)[submasks(path)]
            if start:
                weights[i] += met
            else:
                weights.append(met)
    within: dict[int, np.ndarray] = {}
    out = np.zeros((explained.shape[1], n + 2))
    spread = np.zeros((1 << n, n + 2))
    for start in range(0, explained.shape[1], MASK_ROWS):
        part = slice(start, start + MASK_ROWS)
        for i, (value, path, broken) in enumerate(leaf_masks(tree, explained[:, part], bits)):
            own = submasks(path)
            if path not in within:
                within[path] = np.zeros((len(own), n))
                np.add.at(within[path], np.searchsorted(own, np.arange(1 << n) & path), table)
            k = path.bit_count()
            share = subset_sums(weights[i], k)
            # The last of a list of submasks is the whole mask: what a row does not break is the list read backwards.
            spread[own, 2:] = value * subset_sums(within[path] * share[:, None], k)[::-1]
            spread[own, :2] = value * share[0], 0.0
            spread[0, 1] = value * share[-1]
            out[part] += np.take(spread, broken, axis=0)
    return out


def grown_sums(
    fitted: Fitted, rows: DataFrame, row_id: str, others: DataFrame, variables: Sequence[str], coefficients: dict[int, list[float]]
) -> DataFrame:
    """:func:`forest_sums` of a forest over bins.

    Rows with the same bins in all slots have the same values: each such pattern is explained once, and counted once in the
    background. The patterns are sent to as many tasks as there are cores, each of which adds its share of the trees; the rows
    themselves stay where they are. Work grows with patterns times leaves.
    """
    spark, n, model, bits = rows.sparkSession, len(variables), fitted.model, variable_bits(fitted)
    sent, layout = model.sent(spark), grown.Layout.of(model.thresholds)
    tasks = min(len(model.trees), spark.sparkContext.defaultParallelism)
    table = np.zeros((1 << n, n))
    for mask, values in coefficients.items():
        table[mask] = values

    @F.arrow_udf("binary")
    def pattern(vectors: pa.Array) -> pa.Array:
        return grown.as_binary(layout.pack(grown.binned(grown.matrix(vectors, len(bits)), sent.value[0])))

    def patterned(df: DataFrame) -> DataFrame:
        return fitted.preprocessor.transform(df).withColumn("_pattern", pattern(vector_to_array("features")))

    own = cut_lineage(patterned(rows.select(F.col(row_id).alias("row_id"), *variables)).select("row_id", "_pattern", F.struct(*variables).alias("_own")))
    told = own.select("_pattern").distinct().withColumn("_w", F.lit(None).cast("double"))
    told = told.unionByName(patterned(others).groupBy("_pattern").agg(F.sum("_w").alias("_w")))
    dealt = cut_lineage(told).select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "_pattern", "_w")
    names = ["base", "prediction", *(f"_phi{i}" for i in range(n))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, weights, task = [], [], None
        for batch in batches:
            if batch.num_rows:
                task = batch.column(0)[0].as_py()
                found.append(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, layout.width))
                weights.append(batch.column(2).to_numpy(zero_copy_only=False))
        if task is None:
            return
        packed, w = np.concatenate(found), np.concatenate(weights).astype(float)
        order = np.lexsort(packed.T[::-1])  # sums in the same order in every run
        packed, w = packed[order], w[order]
        known = ~np.isnan(w)
        codes = np.stack([packed[:, layout.byte[s]] >> layout.shift[s] & layout.mask[s] for s in range(len(bits))])
        explained, background, shares = np.ascontiguousarray(codes[:, ~known]), np.ascontiguousarray(codes[:, known]), w[known]
        out = np.zeros((explained.shape[1], n + 2))
        trees = sent.value[1]
        for tree in trees[task::tasks]:
            out += tree_sums(tree, explained, background, shares, bits, table)
        out /= len(trees)
        patterns = packed[~known]
        for start in range(0, len(out), MASK_ROWS):
            part = slice(start, start + MASK_ROWS)
            columns = [pa.array([p.tobytes() for p in patterns[part]], pa.binary()), *[pa.array(np.ascontiguousarray(c)) for c in out[part].T]]
            yield pa.RecordBatch.from_arrays(columns, ["_pattern", *names])

    parts = dealt.repartitionById(tasks, F.col("task")).mapInArrow(add, "_pattern binary, " + ", ".join(f"{c} double" for c in names))
    sums = cut_lineage(parts).groupBy("_pattern").agg(*[F.sum(c).alias(c) for c in names])
    return own.join(sums, "_pattern").drop("_pattern")


def additive_sums(
    preprocessor: Preprocessor, coefficients: Sequence[float], intercept: float, rows: DataFrame, row_id: str, others: DataFrame
) -> DataFrame:
    """The same columns for a score that is ``intercept`` plus ``coefficients`` times the features, exactly."""
    terms, start = [], 0
    for _, slots in preprocessor.variables:
        weights = F.array(*[F.lit(float(w)) for w in coefficients[start : start + slots]])
        own = F.slice("_features", start + 1, slots)
        terms.append(F.aggregate(F.zip_with(own, weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x))
        start += slots
    variables = preprocessor.numeric + preprocessor.categorical

    def termed(df: DataFrame, *kept: Column) -> DataFrame:
        vectors = preprocessor.transform(df).withColumn("_features", vector_to_array("features"))
        return vectors.select(*kept, *[t.alias(f"_t{i}") for i, t in enumerate(terms)])

    mean = termed(others, F.col("_w")).agg(*[F.sum(F.col(f"_t{i}") * F.col("_w")).alias(f"_m{i}") for i in range(len(terms))])
    own = termed(rows, F.col(row_id).alias("row_id"), F.struct(*variables).alias("_own"))
    added = lambda name: reduce(lambda a, b: a + b, [F.col(f"{name}{i}") for i in range(len(terms))], F.lit(float(intercept)))
    # The means are one row.
    return own.crossJoin(F.broadcast(mean)).select(
        "row_id", "_own", added("_m").alias("base"), added("_t").alias("prediction"),
        *[(F.col(f"_t{i}") - F.col(f"_m{i}")).alias(f"_phi{i}") for i in range(len(terms))],
    )


def shapley_values(
    fitted: Fitted,
    rows: DataFrame,
    row_id: str,
    background: DataFrame,
    background_keys: Sequence[str],
    background_rows: int | None = None,
    permutations: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Long table ``(row_id, feature, phi, base, prediction)``: shares of the probability for forests, of the log-odds for logistic models.

    The background is all rows of the table ``background``, or a seeded sample of ``background_rows``
    if a number is given. Exact over all coalitions unless a number of ``permutations`` is asked for: then forests get an estimate
    from so many seeded orders. Too many variables for the tables of a forest raise. In all cases the
    values of a row add up to its prediction minus the mean background prediction. Explain
    distinct feature profiles rather than raw rows where rows repeat.
    """
    variables = fitted.preprocessor.numeric + fitted.preprocessor.categorical
    n = len(variables)
    is_forest = isinstance(fitted.model, RandomForestClassificationModel | grown.GrownForest)
    if is_forest and n > MOST_VARIABLES:
        raise ValueError(f"{n} variables have too many coalitions")
    chosen = background
    if background_rows is not None:
        chosen = seeded_sample(background.select(*dict.fromkeys([*background_keys, *variables])), background_keys, background_rows, seed)
    # Equal rows are one profile with their share of all rows.
    profiles = cut_lineage(chosen.groupBy(*variables).agg(F.count(F.lit(1)).alias("_n")))
    others = profiles.withColumn("_w", F.col("_n") / profiles.agg(F.sum("_n")).scalar())
    if is_forest:
        coefficients = exact_coefficients(n) if permutations is None else sampled_coefficients(n, permutations, seed)
        sums_of = grown_sums if isinstance(fitted.model, grown.GrownForest) else forest_sums
        sums = sums_of(fitted, rows, row_id, others, variables, coefficients)
    else:
        sums = additive_sums(fitted.preprocessor, fitted.model.coefficients.toArray().tolist(), fitted.model.intercept, rows, row_id, others)
    return long_values(sums, fitted.preprocessor)


def long_values(sums: DataFrame, preprocessor: Preprocessor) -> DataFrame:
    """One row per row and variable; categories are named ``column=value``."""
    entries = []
    for i, v in enumerate(preprocessor.numeric + preprocessor.categorical):
        name = F.lit(v)
        if v in preprocessor.categorical:
            name = F.concat(F.lit(f"{v}="), F.coalesce(F.col(f"_own.{v}").cast("string"), F.lit("null")))
        entries.append(F.struct(name.alias("feature"), F.col(f"_phi{i}").alias("phi")))
    return sums.select("row_id", F.inline(F.array(*entries)), "base", "prediction")
