"""Links of sets that differ much in size, and pipeline stages on tables with columns of the operators' own names."""

import random

import corpus_pipeline
from edugauge.llm import ngram_join


def test_low_threshold_reaches_every_size_class(spark):
    """Pairs at 20/100 whose sizes lie two classes apart: 63 words and 228, 256 or 310 of them, against all pairs."""
    rng = random.Random(3)
    words = [f"w{i:04d}" for i in range(6000)]
    table = []
    for k, size in enumerate((228, 256, 310, 316, 90)):
        large = rng.sample(words, size)
        table += [(10 * k, " ".join(large[:63])), (10 * k + 1, " ".join(large)), (10 * k + 2, " ".join(rng.sample(words, 70)))]
    sets = {i: set(t.split()) for i, t in table}
    near = {i: [j for j in sets if j != i and 100 * len(sets[i] & sets[j]) >= 20 * len(sets[i] | sets[j])] for i in sets}
    found = ngram_join.link(spark.createDataFrame(table, "doc_id long, text string"), shingle=1, num=20, den=100).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_links"]) for r in found} == {i: (min([i, *near[i]]), len(near[i])) for i in sets}
    assert sum(map(len, near.values())) == 8  # 63 of 316 words are too few


def test_stages_keep_columns_with_the_names_of_operators(spark, tmp_path):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=30)) + (" zorkish vexmuk grubbel" * 3 if i % 4 == 0 else "") for i in range(120)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, copy int, copies string, shuffle_key long, predicted int"
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 2}", len(t), i / 7, 99, "own", -i, 5) for i, t in enumerate(texts)], schema)
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    own = {r["doc_id"]: tuple(r) for r in docs.collect()}
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.mix_sources):
        kept = stage(spark, docs, str(tmp_path))
        rows = kept.collect()
        assert kept.columns == docs.columns and rows
        assert all(tuple(r) == own[r["doc_id"]] for r in rows), stage
    assert corpus_pipeline.encode(spark, docs, str(tmp_path)).columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
