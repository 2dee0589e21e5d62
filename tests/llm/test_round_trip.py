"""Encoding and decoding by one worker: the same rows as one after the other, with tables of bounded bytes."""

import base64
import random

import public_tokenizers
import tiktoken

from edugauge.llm import bpe


def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def test_round_trip_equals_encode_then_decode(spark):
    texts = ["Hello  world's été 😀\n\n123456", None, "", "x" * 2_000_000, "lone \x1c, 日本語 " * 50, "a\tb"]
    docs = spark.createDataFrame([(i, t, "k", "d") for i, t in enumerate(texts * 2)], "doc_id long, text string, ids string, `decoded` string")
    ranks = vocabulary()
    both = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    apart = bpe.decode(bpe.encode(docs.drop("ids", "decoded"), ranks, public_tokenizers.PATTERN), ranks)
    assert both.columns == apart.columns == ["doc_id", "ids", "decoded"]
    found = sorted(map(tuple, both.collect()))
    assert found == sorted(map(tuple, apart.collect()))
    assert [r[2] for r in found] == [t or "" for t in texts * 2]
    assert bpe.round_trip(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_tables_stay_bounded_and_the_output_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "MATCH_BYTES", 20_000)
    monkeypatch.setattr(bpe, "MAX_TRANSITIONS", 2_000)
    ranks, rng = vocabulary(), random.Random(4)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    split, matches = bpe._encoder(ranks, public_tokenizers.PATTERN, ("bounded",))
    for _ in range(300):
        text = " ".join("".join(rng.choices("aeinrstlqzäß日", k=rng.randrange(1, 9))) for _ in range(12))
        ids = b"".join(map(matches.__getitem__, split(text)))
        assert list(memoryview(ids).cast("I")) == known.encode_ordinary(text)
        assert matches.bytes <= 20_000 and len(matches.transducer.steps) <= 2_000
        assert len(matches.transducer.parts) <= 2_001
