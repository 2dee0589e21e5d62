"""Toxicity of words that few texts hold, its score as a plain loop, and reshardings of mixed sizes against enumeration."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edugauge.llm import resharding, toxicity

MASK = (1 << 32) - 1


def _texts(words, rng, extra, n):
    found = []
    for _ in range(n):
        chosen = [rng.choice(words) for _ in range(30)]
        found.append(" ".join([*chosen[:11], extra, *chosen[11:]] if extra else chosen))
    return found


def test_toxicity_learns_a_rare_word():
    """6,000 texts, 600 toxic by one word and 25 by another: new texts with either score over 0.5, clean ones do not."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(600)]
    texts = [*_texts(words, rng, "zorgle", 600), *_texts(words, rng, "quivnox", 25), *_texts(words, rng, None, 5375)]
    model = toxicity.train(texts, [1] * 625 + [0] * 5375)
    for word, least, most in (("zorgle", 0.95, 1), ("quivnox", 0.9, 1), (None, 0, 0.02)):
        share = float((model.score(_texts(words, rng, word, 200)) >= 0.5).mean())
        assert least <= share <= most, (word, share)


def _bucket(h):
    h = (h ^ (h >> 15)) * 0x85EBCA6B & MASK
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & MASK
    return h >> (32 - toxicity.BUCKET_BITS)


def _plain_score(model, text):
    """Every distinct word, character by character."""
    spread, base = int(toxicity.SPREAD), int(toxicity.BASE)
    blanks = {chr(c) for c in range(33)} | {"\x85", "\xa0"}
    words = set("".join(" " if c in blanks else c for c in (text or "").lower()).split(" ")) - {""}
    total, count = 0.0, 0
    for word in words:
        code = [ord(c) for c in word]
        edged = [0, *code, 0]
        for n in toxicity.ORDERS:
            for i in range(len(edged) - n + 1):
                h = (edged[i] + 1) * spread & MASK
                for c in edged[i + 1 : i + n]:
                    h = (h * base + (c + 1) * spread) & MASK
                total, count = total + float(model.weights[_bucket((h + n) & MASK)]), count + 1
        mixed = [(c + 1) * spread & MASK for c in code]
        plain = sum(m * ((m >> 7) | 1) for m in mixed) & MASK
        pairs = sum(((a * base & MASK) ^ b) * spread for a, b in itertools.pairwise(mixed)) & MASK
        total, count = total + float(model.weights[_bucket((plain * base + pairs + 1) & MASK)]), count + 1
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, total / max(count, 1) + model.bias))))


def test_toxicity_score_equals_plain_loop():
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.standard_normal(1 << toxicity.BUCKET_BITS).astype(np.float32), -0.25)
    texts = ["", " \t\n ", "a", "ab cd  ab", "The the THE end", "naïve Ünïcode 漢字 😀 x\xa0y", "tab\tand\nline", "w" * 300, "one two three four five " * 40]
    assert model.score(texts) == pytest.approx([_plain_score(model, t) for t in texts], abs=1e-6)


def test_toxicity_takes_a_very_long_text():
    model = toxicity.Model(np.full(1 << toxicity.BUCKET_BITS, 0.5, np.float32), 0.0)
    long = "word and other " * 200_000 + "x" * 1_000_000
    assert model.score([long, "", "word"])[0] == pytest.approx(1 / (1 + math.exp(-0.5)), abs=1e-4)


def _least_bytes(shards, new):
    """All choices of the shards that take one row more; each shard keeps its largest rows."""
    base, more = divmod(sum(map(len, shards)), new)
    kept = [sorted(rows, reverse=True) for rows in shards[:new]] + [[] for _ in range(new - len(shards))]
    best = max(sum(sum(rows[: base + (i in chosen)]) for i, rows in enumerate(kept)) for chosen in itertools.combinations(range(new), more))
    return sum(map(sum, shards)) - best


@pytest.mark.parametrize("seed", range(4))
def test_reshard_moves_the_fewest_bytes(spark, seed):
    """Sizes of one power of two and of many, fewer and more shards than before, some of them empty."""
    rng = random.Random(seed)
    old, new = rng.randint(2, 5), rng.randint(2, 6)
    sizes = [[rng.randint(9, 15) if seed % 2 else rng.choice((1, 3, 17, 30, 90)) for _ in range(rng.randint(0, 12))] for _ in range(old)]
    rows = [(1000 * s + i, "x" * (n - 1), s) for s, shard in enumerate(sizes) for i, n in enumerate(shard)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, was int")
    found = resharding.reshard(docs, F.col("was"), new).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, *_ in rows)
    slots = {s: sorted(r["slot"] for r in found if r["shard"] == s) for s in range(new)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sum(len(r["text"]) + 1 for r in found if r["shard"] != r["was"]) == _least_bytes(sizes, new)
