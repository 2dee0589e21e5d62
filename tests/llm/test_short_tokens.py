"""Order A of the n-gram join goes by shortened tokens."""

import numpy as np
import pyarrow as pa

from edugauge.llm import ngram_join


def _texts():
    rng = np.random.default_rng(5)
    texts = []
    for n in (4, 9, 40, 90, 300):
        for _ in range(6):
            words = [f"w{i}" for i in rng.integers(0, 500, n)]
            near = list(words)
            near[n // 2] = "other"
            texts += [" ".join(words), " ".join(near), " ".join([*words, "more"])]
    return texts


def test_tokens_of_order_a_have_48_bits():
    batch = pa.RecordBatch.from_pydict({"_id": pa.array([1], pa.int64()), "_text": pa.array([_texts()[-1]])})
    (signed,) = ngram_join._signatures(5, 80, 100)(iter([batch]))
    tokens = [t for unit in signed.to_pylist()[0]["units"] for t in unit["tokens"]]
    assert len(tokens) > 60 and all(0 <= t < 2**48 for t in tokens)


def test_no_link_is_lost_when_tokens_fall_together(spark, monkeypatch):
    """With 6 bits nearly all tokens of order A are one of 64 values: more candidates, the same links."""
    monkeypatch.setattr(ngram_join, "DROPPED", np.uint64(58))
    texts = _texts()
    sets = [frozenset(ngram_join.tokens_of(t, 3).tolist()) for t in texts]
    links = [sum(i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_links"] for r in ngram_join.link(docs, 3, 80, 100).collect()}
    assert found == dict(enumerate(links)) and sum(links) > 20
