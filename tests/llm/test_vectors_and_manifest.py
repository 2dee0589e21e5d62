"""Vector codes, top-k search and Merkle manifests against brute force, with the odd rows that each docstring defines."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edugauge.llm import manifest, topk_join, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, score string, uid int, `a.b` string"


def vector_rows(n=150, dims=32, seed=3):
    """Random vectors with nulls, holes, infinities, short and empty vectors, ties, hot copies and repeated rows."""
    rng = np.random.default_rng(seed)
    some = rng.normal(0, 0.4, (n, dims)).astype(np.float32)
    some[: n // 3] = some[0]  # a hot vector
    some[n // 3 : n // 2] = some[n // 3] + rng.normal(0, 0.01, (n // 2 - n // 3, dims)).astype(np.float32)
    rows = [(i, [float(x) for x in v], i % 4 or None) for i, v in enumerate(some)]
    rows += [(n, None, 1), (n + 20, [], 2), (n + 40, [1.0, None], 1), (n + 41, [float("nan")] * dims, 1), (n + 42, [float("inf"), 1.0], None)]
    rows += [(n + 60, [0.5] * 7, 3), (None, rows[5][1], 1), (None, None, None), rows[40], rows[40], (40, rows[41][1], 2)]
    return [(*r, "c", 1, "s", 2, "x") for r in rows]


def whole(rows, scale):
    """Kept rows as whole numbers, filled up with zeros."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dims = max((len(r[1]) for r in kept), default=0)
    return kept, [[math.floor(scale * x) for x in r[1]] + [0] * (dims - len(r[1])) for r in kept]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], VECTORS)


# ---- vector codes


def brute_codes(rows, parts, entries, rounds, scale):
    kept, x = whole(rows, scale)
    width = -(-max(map(len, x)) // parts)
    x = [v + [0] * (parts * width - len(v)) for v in x]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in x]
    order = sorted(range(len(x)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, x[i]))[:entries]
    books = [[list(cut[i][p]) for i in order] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for j, found in members.items():
                books[p][j] = [sum(column) // len(found) for column in zip(*found)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    return kept, [(bytes(j for _, j in f), sum(d for d, _ in f)) for f in found], books


@pytest.mark.parametrize("entries", [1, 5, 64])
def test_codes_equal_brute_force(vectors, entries):
    kept, expected, books = brute_codes(vector_rows(), 16, entries, 2, 256)
    book = vector_codes.fit(vectors, "vec_id", "embedding", entries=entries)
    assert book.entries.tolist() == books
    assert book.text() == ",".join(str(x) for part in books for entry in part for x in entry)
    coded = vector_codes.encode(vectors, book, "embedding")
    assert coded.columns == ["vec_id", "label", "score", "uid", "a.b", "code", "error"]
    found = sorted(((r["vec_id"], bytes(r["code"]), r["error"]) for r in coded.collect()), key=str)
    assert found == sorted(((k[0], *e) for k, e in zip(kept, expected)), key=str)
    decoded = vector_codes.decode(coded, book).filter("vec_id = 3").first()
    assert decoded["decoded"] == [x / 256 for p, j in enumerate(decoded["code"]) for x in books[p][j]]


def test_candidates_hold_every_entry_within_the_nearest_distance():
    rng = np.random.default_rng(5)
    book = vector_codes.Codebooks(rng.integers(-30, 30, (2, 64, 4)), 1)
    x = rng.integers(-40, 40, (500, 4))
    for part in range(2):
        distance = ((x[:, None] - book.entries[part]) ** 2).sum(axis=2)
        mask = book.candidates(part, x)
        inside = (mask[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool)
        assert inside[distance == distance.min(axis=1)[:, None]].all() and inside.mean() < 0.6
        entry, least = book.nearest(part, x)
        assert (entry == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_codes_of_empty_tables_and_large_components(spark, no_vectors, vectors):
    book = vector_codes.fit(no_vectors, "vec_id", "embedding")
    assert book.text() == "" and vector_codes.encode(no_vectors, book, "embedding").count() == 0
    only_bad = vectors.filter("embedding is null")
    assert vector_codes.encode(only_bad, vector_codes.fit(only_bad, "vec_id", "embedding"), "embedding").count() == 0
    with pytest.raises(ValueError, match="too large"):
        vector_codes.fit(spark.createDataFrame([(1, [3e30])], "vec_id long, embedding array<double>"), "vec_id", "embedding")


# ---- top-k search


def brute_top(rows, k, step, scale):
    kept, x = whole(rows, scale)
    out = []
    for i, (q, v) in enumerate(zip(kept, x)):
        if q[0] is None or q[0] % step:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), r[0] is None, r[0] or 0, r[0]) for j, (r, w) in enumerate(zip(kept, x)) if j != i]
        out += [(q[0], rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "block", "chunk", "cells"), [(20, 8192, 16384, 8), (3, 10, 2, 3), (500, 16, 16384, 1)])
def test_top_k_equals_brute_force(vectors, monkeypatch, k, block, chunk, cells):
    for name, value in (("BLOCK_ROWS", block), ("CHUNK_ROWS", chunk), ("FEWEST_CELLS", cells)):
        monkeypatch.setattr(topk_join, name, value)
    found = topk_join.top_k(vectors, F.col("vec_id") % 5 == 0, k)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_top(vector_rows(), k, 5, 64)


def test_top_k_leaves_out_far_cells_and_loses_nothing(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 40, (6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(0, 0.5, 8)]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_join.top_k(table, F.col("vec_id") % 10 == 0, 5)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_top(rows, 5, 10, 64)
    pivots = (centres * 64).astype(np.int64)
    summary = [
        {"cell": c, "ring": 0, "n": 100, "nearest": 0, "farthest": 10_000, "shortest": int((pivots[c] ** 2).sum()), "longest": int((pivots[c] ** 2).sum()), "queries": 10, "query_farthest": 10_000}
        for c in range(6)
    ]
    assert sum(map(len, topk_join.needed_rings(pivots, summary, 5).values())) < 30


def test_products_beyond_floating_point_are_exact(spark, no_vectors):
    big = [(i, [float(2**21 + i), float(i * 3 % 7)]) for i in range(40)]
    found = topk_join.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 4, scale=64)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_top(big, 4, 20, 64)
    assert topk_join.top_k(no_vectors, F.col("vec_id") % 20 == 0).count() == 0
    with pytest.raises(ValueError, match="too large"):
        topk_join.top_k(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), F.lit(True)).count()


# ---- Merkle manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp string, `a.b` string"


def doc_rows(n, seed=7):
    rng = random.Random(seed)
    rows = [(i * 3 % (2 * n), f"Text {i} " + "é" * rng.randrange(5), "hot" if i % 3 else f"l{i % 9:02d}", f"s{i % 4}", i) for i in range(n)]
    rows += [(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (5, "x" * 3_000_000 + "Z", "ä", None, 1), (-7, "ABC", "ä", "", None), (None, "q", "ä", "", 3)]
    return [(*r, "L", "G", "x") for r in rows]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(r):
    values = [r[0], r[3], r[2], r[4], r[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves, fanout):
    """Root, and for each leaf its siblings and places from the bottom up."""
    ways, at, level = [([], []) for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for leaf, (siblings, places) in enumerate(ways):
            run, place = runs[at[leaf] // fanout], at[leaf] % fanout
            siblings += run[:place] + run[place + 1 :]
            places.append((place, len(run)))
            at[leaf] //= fanout
        level = [sha("".join(run)) for run in runs]
    return level[0], ways


def brute_manifest(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0), brute_leaf(r), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([leaf for _, leaf, _ in sorted(groups[g], key=str_key)], fanout) for g in names]
    root, top = brute_tree([t[0] for t in trees], fanout)
    out = []
    for g, (subroot, ways), (upper, where) in zip(names, trees, top):
        for (_, leaf, ident), (siblings, places) in zip(sorted(groups[g], key=str_key), ways):
            out.append((ident, leaf, subroot, root, "".join(siblings + upper), tuple(places + where)))
    return sorted(out, key=str)


def str_key(entry):
    return entry[0], entry[1]


@pytest.mark.parametrize(("n", "fanout", "levels"), [(400, 8, 4), (400, 2, 1), (403, 3, 1), (90, 8, 1), (700, 4, 2), (1, 8, 4)])
def test_manifest_equals_brute_force(spark, n, fanout, levels):
    docs = spark.createDataFrame(doc_rows(n), DOCS).repartition(3)
    found = manifest.manifest(docs, fanout=fanout, block_levels=levels).withColumn("folded", manifest.folded()).collect()
    assert all(r["folded"] == r["root"] and r["claim"] == r["leaf"] for r in found)
    mine = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], tuple((p["at"], p["size"]) for p in r["places"])) for r in found]
    assert sorted(mine, key=str) == brute_manifest(doc_rows(n), fanout)


def test_claims_fold_to_other_roots_and_empty_tables(spark):
    docs = spark.createDataFrame(doc_rows(60), DOCS)
    lower = {c: F.col(c) for c in manifest.FIELDS} | {"text": F.lower("text")}
    proved = manifest.manifest(docs, claim=manifest.leaf(list(lower.values())), fanout=2, block_levels=2)
    for r in proved.withColumn("folded", manifest.folded("claim")).collect():
        assert (r["folded"] == r["root"]) == (r["claim"] == r["leaf"])
        h, done = r["claim"], 0
        for at, size in r["places"]:
            others = [r["proof"][64 * i : 64 * i + 64] for i in range(done, done + size - 1)]
            h, done = sha("".join([*others[:at], h, *others[at:]])), done + size - 1
        assert h == r["folded"]
    none = manifest.manifest(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "claim", "subroot", "root", "proof", "places"]
    alone = manifest.manifest(docs.filter("doc_id = -7")).first()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof"] == "" and alone["places"] == []
