"""Corpus operators against brute force, round trips and held-out accuracy, with the odd rows that each docstring defines."""

import base64
import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from edugauge.llm import bpe, components, exact_dedup, language, line_dedup, mixing, ngram_join, resharding, toxicity, url_filters, winnowing

SCHEMA = "doc_id long, text string, lang string, source string, fp string, `a.b` string, kept string, token int, shard string, copy string"
PLAIN = "the quick brown fox jumps over the lazy dog while seven other animals look on in mild surprise and then walk away"


def rows():
    """Nulls in every column, empty and long texts, copies, near copies, ties and repeated rows."""
    texts = [
        PLAIN, PLAIN.upper(), PLAIN + " again", "", None, " \t\n", "one", "one two", "ONE two", "word " * 4000, "a b c\na b c\nunique line here\r",
        "A shared line of text\nsomething else entirely", "first\n  a SHARED line of text \t\nlast", "été naïve Straße 😀 日本語", "  x", PLAIN,
    ]
    found = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None) for i, t in enumerate(texts)]
    found += [(None, PLAIN, "en", "src0"), (None, None, None, None), (3, "", "en", "src1"), (7, "one two", "en", "src2"), (7, "one two", "en", "src2")]
    return [(*r, "x", "y", "z", 1, "w", "c") for r in found]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- exact dedup


def test_rice_code_round_trip():
    rng = random.Random(1)
    for n in (1, 2, 50, 1000):
        for top in (n + 1, 1 << 20, 1 << 60):
            values = np.array(sorted(rng.sample(range(min(top, 1 << 60)), n)), np.uint64)
            assert (exact_dedup.rice_decode(n, *exact_dedup.rice_encode(values)) == values).all()


def test_exact_dedup_equals_grouping(docs, empty):
    found = exact_dedup.mark(docs).collect()
    groups = {}
    for r in rows():
        groups.setdefault(lower(r[1]), []).append(r[0])
    assert len(found) == len(rows())
    for text, ids in groups.items():
        mine = [r for r in found if r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in mine)
        top = max((i for i in ids if i is not None), default=None)
        assert {r["keep_id"] for r in mine} == {top} and {r["group_size"] for r in mine} == {len(ids)}
        assert [r["doc_id"] for r in mine if r["kept"]] == [top]
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.mark(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


# ---- line dedup


def test_line_dedup_equals_brute_force(docs, empty):
    last = 1 << 63
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for r in rows():
        for line in (r[1] or "").split("\n"):
            first[key(line)] = min(first.get(key(line), last), last if r[0] is None else r[0])
    expected = []
    for r in rows():
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or (last if r[0] is None else r[0]) <= first[key(x)]]
        expected.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    for batches in (1, 4):
        found = [tuple(r) for r in line_dedup.drop_lines(docs, batches=batches, fanout=2).collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)
    assert line_dedup.drop_lines(empty).count() == 0


def test_line_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(5):
        batch = spark.createDataFrame([(i, h, h) for h in range(i, i + 3)], "id long, h1 long, h2 long")
        late = {(r["id"], r["h1"]) for r in runs.add(batch).collect()}
        assert late == ({(i, i), (i, i + 1)} if i else set())
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r["h1"] for level in runs.levels for run in level for r in run.collect()) == list(range(7))


# ---- mixing


def test_poisson_inverse_and_shares(spark, docs, empty):
    steps = mixing.poisson_steps(2.5)
    assert steps == sorted(steps) and abs(steps[0] - np.exp(-2.5)) < 1e-15
    many = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 30)).alias("source"))
    mixed = mixing.mix(many, {"big": 1.0, "s1": 3.0, "none": 5.0}, epochs=1.0, seed=3).groupBy("source").count().collect()
    sizes = {r["source"]: r["count"] for r in mixed}
    assert abs(sizes["s1"] / sizes["big"] - 3) < 0.15 and abs(sizes["s1"] + sizes["big"] - 22_000) < 700
    assert abs(sizes["s2"] - 2000) < 200
    found = mixing.mix(docs, {"src1": 1.0, "src2": 1.0}, epochs=3.0)
    assert set(found.columns) == {*docs.columns, "copies", "shuffle_key"}
    copies = found.groupBy("doc_id", "text").agg(F.collect_list("copy").alias("c"), F.max("copies").alias("n"), F.count("*").alias("k")).collect()
    assert all(r["k"] % r["n"] == 0 and set(r["c"]) == set(range(r["n"])) for r in copies)
    assert mixing.mix(empty, {"src1": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(many, {"big": 1.0, "s1": 1e9}, max_rate=5.0)


# ---- byte-level BPE


def test_bpe_equals_tiktoken_and_round_trips(docs, empty, vocabulary):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    encoded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    assert "text" not in encoded.columns and encoded.count() == len(rows())
    decoded = bpe.decode(encoded, vocabulary)
    expected = sorted((str(r[0]), struct.pack(f"<{len(i)}I", *i), r[1] or "") for r in rows() for i in [reference.encode_ordinary(r[1] or "")])
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), r["decoded"]) for r in decoded.collect()) == expected
    assert bpe.encode(empty, vocabulary, public_tokenizers.PATTERN).count() == 0


def test_bpe_transducer_fuzz_with_resets(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_TRANSITIONS", 300)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    machine, rng = bpe.Transducer(vocabulary), random.Random(2)
    pieces = ["a", "th", "in", " ", "é", "日", "er", "A", "1", "\n", "😀", "ing", "aaaa", "--", "'s", "\x1c", " "]
    split, _ = bpe._encoder(vocabulary, public_tokenizers.PATTERN)
    for _ in range(1500):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 12)))
        ids = list(itertools.chain.from_iterable(machine.encode(m.encode()) for m in split(text)))
        assert ids == reference.encode_ordinary(text)


def test_utf8_machine_equals_python():
    rng = random.Random(3)
    for _ in range(3000):
        data = bytes(rng.choice((0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xED, 0xA0, 0xF0, 0x90, 0xF4, 0xFF)) for _ in range(rng.randint(0, 9)))
        machine = bpe.Utf8Machine()
        cut = rng.randint(0, len(data))
        assert machine.feed(data[:cut]) + machine.feed(data[cut:]) + machine.end() == data.decode("utf-8", "replace")


# ---- toxicity and language


def made_up(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    data = [(i, made_up(rng, plain, 60) + (" " + rng.choice(("zorkish", "vexmuk")) if i % 2 else ""), i % 2) for i in range(1000)]
    model = toxicity.train([t for _, t, _ in data[:800]], [c for *_, c in data[:800]], steps=8000)
    scores = model.score([t for _, t, _ in data[800:]])
    assert np.mean((scores >= 0.5) == np.array([c for *_, c in data[800:]])) > 0.9
    unseen = model.score([made_up(rng, plain, 20) + " zorkishh" for _ in range(50)])
    assert unseen.mean() > model.score([made_up(rng, plain, 20) + " plainword" for _ in range(50)]).mean()
    alone, together = model.score([data[0][1]])[0], model.score(["", data[0][1], "  "])
    assert abs(alone - together[1]) < 1e-9 and together[0] == together[2]


def test_toxicity_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(0, 1), (2, 0), (4, 1), (99, 1), (5, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(False))
    found = toxicity.score(docs, model)
    assert found.count() == len(rows()) and found.filter("score between 0 and 1").count() == len(rows())
    assert toxicity.score(empty, toxicity.fit(empty, labels, F.lit(False))).count() == 0


def test_toxicity_sample_passes_over_long_texts_and_takes_an_id_once(spark):
    kind = "doc_id long, text string"
    first = min(range(40), key=lambda i: spark.sql(f"select xxhash64({i}L)").first()[0])
    data = [(i, "x" * 90 if i == first else f"text {i}") for i in range(40)] + [(100, "far" * 60)]
    labels = spark.createDataFrame([(i, int(i % 2 == first % 2)) for i in range(40)] + [(100, 1)], "doc_id long, toxic int")
    texts, classes = toxicity.training_rows(spark.createDataFrame(data, kind), labels, F.lit(False), "doc_id", "text", 1000, 100)
    assert sum(classes) >= 1 and classes.count(0) >= 1 and sum(len(t) for t in texts) <= 100
    short = toxicity.training_rows(spark.createDataFrame(data, kind), labels, F.lit(False), "doc_id", "text", 1000, 160)
    assert sum(short[1]) > 5  # the text of 90 bytes comes first in hash order and does not fit 80
    repeated = spark.createDataFrame([(i, t + " again" * k) for i, t in data[:4] for k in range(50)], kind)
    few = toxicity.training_rows(repeated, labels, F.lit(False), "doc_id", "text", 4, 10_000)
    assert sorted(few[0]) == sorted(t for _, t in data[:4]) and sorted(few[1]) == [0, 0, 1, 1]
    with pytest.raises(ValueError, match="class 1"):
        toxicity.fit(spark.createDataFrame([(0, "a"), (1, "b" * 200)], kind), spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int"), F.lit(False), max_bytes=100)


def test_language_held_out(spark, docs, empty):
    rng = random.Random(5)
    words = {"xx": ["abra", "kadab", "bara"], "yy": ["tillo", "mello", "fell"], "zz": ["жук", "мука", "кум"]}
    data = [(i, made_up(rng, words[k], 30), k) for i, k in enumerate(rng.choices(list(words), k=240))]
    table = spark.createDataFrame([*data, (900, None, "xx"), (901, "123 !?", "yy"), (902, "abra bara", None)], "doc_id long, text string, lang string")
    held_out = F.col("doc_id") % 3 == 1
    found = {r["doc_id"]: r for r in language.predict(table, language.fit(table, held_out, sample_rows=20)).collect()}
    assert all(found[i]["lang_pred"] == k for i, _, k in data)
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == "und" and found[900]["score"] == 0 and found[902]["lang_pred"] == "xx"
    assert all(r["lang_pred"] == "und" for r in language.predict(docs, language.fit(empty, F.lit(False))).collect())
    assert language.predict(docs, language.fit(docs, F.lit(False))).count() == len(rows())


# ---- winnowing


def test_winnowing_selects_rightmost_minima():
    rng = random.Random(6)
    for n in (1, 5, 12, 40, 41, 300, 2000):
        text = "".join(rng.choices("ab c", k=n))
        hashes = winnowing.gram_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), min(winnowing.K, n)).tolist()
        chosen = set()
        for s in range(max(1, len(hashes) - winnowing.WINDOW + 1)):
            window = hashes[s : s + winnowing.WINDOW]
            chosen.add(s + max(i for i, h in enumerate(window) if h == min(window)))
        assert sorted(chosen) == winnowing.select(text)[1].tolist()


def test_winnowing_blocks_and_guarantee(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choices("abcdefgh ", k=3000))
    whole = winnowing.select(text)
    monkeypatch.setattr(winnowing, "BLOCK", 100)
    assert all((a == b).all() for a, b in zip(whole, winnowing.select(text)))
    passage = "".join(rng.choices("abcdefgh ", k=winnowing.WINDOW + winnowing.K - 1))
    a, b = (winnowing.select(x + passage + y)[0] for x, y in (("left one ", " right"), ("another start ", " end of it")))
    assert len(np.intersect1d(a, b))


def test_winnowing_next_document(docs, empty):
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for r, following in zip(order, [*order[1:], order[0]]):
        text, other = r[1] or "", following[1] or ""
        half = len(text) // 2
        expected.append((str(r[0]), len(text), hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest()))
    found = winnowing.compare_with_edits(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in found) == sorted(expected)
    by_text = {r["fingerprint"] for r in found if r["n_chars"] == len(PLAIN) and r["doc_id"] in (0, 15)}
    assert len(by_text) == 1
    assert winnowing.compare_with_edits(empty).count() == 0 and winnowing.fingerprint(docs).count() == len(rows())


# ---- resharding


def test_flow_is_cheapest():
    rng = random.Random(8)
    for _ in range(20):
        olds, new = rng.randint(1, 5), rng.randint(1, 6)
        sizes = {o: sorted(rng.choices(range(1, 9), k=rng.randint(0, 12))) for o in range(olds)}
        blocks = {}
        for o, own in sizes.items():
            for s in own:
                n, b = blocks.get((o, s), (0, 0))
                blocks[o, s] = (n + 1, b + s)
        if not blocks:
            continue
        leaving, taking = resharding.plan(blocks, new)
        counts = {o: len(own) for o, own in sizes.items() if own}
        total = sum(counts.values())
        cost = sum(sum(sizes[o][: leaving[o]]) for o in counts)
        best = min(
            sum(sum(sizes[o][: max(0, len(sizes[o]) - (total // new + (o in big) if o < new else 0))]) for o in counts)
            for big in itertools.combinations(range(new), total % new)
        )
        assert cost == best
        moves = resharding.transfers(counts, leaving, taking)
        held = [sum(end - start for _, start, end, n, _ in moves if n == j) for j in range(new)]
        assert sum(held) == total and max(held) - min(held) <= 1


def test_reshard_rewrites_every_row_once(docs, empty):
    for old, new in ((4, 6), (6, 4), (3, 3)):
        shard = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % old
        found = resharding.reshard(docs, shard, new)
        assert set(found.columns) == {*docs.columns, "slot"}
        got = found.collect()
        assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted((str(r[0]), str(r[1])) for r in rows())
        slots = {j: sorted(r["slot"] for r in got if r["shard"] == j) for j in range(new)}
        assert all(s == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert resharding.reshard(empty, F.lit(0), 4).count() == 0


# ---- n-gram Jaccard join


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_links(table, n, num, den):
    sets = [shingles(t, n) for _, t in table]
    near = [[j for j in range(len(table)) if j != i and a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j])] for i, a in enumerate(sets)]
    out = []
    for i in range(len(table)):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [table[j][0] for j in seen if table[j][0] is not None]
        out.append((table[i][0], len(sets[i]), min(ids, default=None), len(near[i])))
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "num", "block"), [(3, 90, 512), (5, 80, 7)])
def test_ngram_join_equals_all_pairs(spark, docs, monkeypatch, n, num, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefg", k=4)) for _ in range(400)]
    common = rng.choices(words, k=40)
    table = [(r[0], r[1]) for r in rows()]
    for i in range(100, 220):
        text = rng.choices(words, k=rng.choice((3, 8, 30, 90))) if i % 3 else list(table[-1][1].split()) if len(table) > 60 else rng.choices(words, k=70)
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        table.append((i, " ".join(text + (common if i % 10 == 0 else []))))
    found = ngram_join.link(spark.createDataFrame(table, "doc_id long, text string"), shingle=n, num=num, den=100)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_links(table, n, num, 100)


def test_ngram_join_keeps_one_of_each(docs, empty):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [lower(r["text"]) for r in kept.collect()]
    assert texts.count(lower(PLAIN)) == 1 and ngram_join.one_of_each(empty).count() == 0 and ngram_join.link(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


# ---- URL filters


def test_url_lists_as_of_fetch_day(spark):
    entries = [
        ("ads", True, "example.org", "add", "2024-01-10"), ("ads", True, "example.org", "remove", "2024-02-10"), ("ads", True, "example.org", "add", "2024-03-10"),
        ("trusted", False, "good.example.org", "add", "2024-01-15"), ("adult", True, "good.example.org/x/", "add", "2024-01-20"),
        ("ads", True, "example.org", "add", "2024-01-12"), ("b", True, "tie.net", "add", "2024-01-01"), ("a", True, "tie.net", "add", "2024-01-02"),
        ("ads", True, "day.net", "add", "2024-01-05"), ("ads", True, "day.net", "remove", "2024-01-05"), (None, True, "tie.net", "add", "2024-01-01"), ("ads", None, "null.net", "add", "2024-01-01"),
    ]
    cases = [
        ("http://www.example.org/a", "2024-01-09", False, None), ("http://www.example.org/a", "2024-01-10", True, "example.org"), ("HTTP://WWW.EXAMPLE.ORG.", "2024-02-09", True, "example.org"),
        ("http://example.org/", "2024-02-10", False, None), ("http://example.org:80/q?x=/y/", "2024-03-11", True, "example.org"), ("http://good.example.org/x/y/z", "2024-01-19", False, "good.example.org"),
        ("http://good.example.org/x/y/z", "2024-01-20", True, "good.example.org/x/"), ("http://u@good.example.org/xy", "2024-01-20", False, "good.example.org"), ("https://tie.net", "2024-01-03", True, "tie.net"),
        ("https://day.net", "2024-01-06", False, None), ("not a url", "2024-01-06", False, None), (None, "2024-01-06", False, None), ("https://tie.net", None, False, None), ("https://null.net", "2024-01-06", False, "null.net"),
    ]
    kind = "list_name string, blocks boolean, key string, action string, day string"
    captures = spark.createDataFrame([(i, u, d, "keep") for i, (u, d, *_) in enumerate(cases * 2)], "page_id long, url string, fetch_day string, steps string")
    found = {r["page_id"]: r for r in url_filters.judge(captures, spark.createDataFrame(entries, kind)).collect()}
    assert len(found) == 2 * len(cases)
    for i, (url, day, blocked, key) in enumerate(cases * 2):
        assert (found[i]["blocked"], found[i]["matched_key"], found[i]["steps"]) == (blocked, key, "keep"), (url, day)
    assert found[8]["list_name"] == "a" and str(found[4]["valid_from"]) == "2024-03-10"
    none = url_filters.judge(captures, spark.createDataFrame([], kind))
    assert none.filter("blocked").count() == 0 and none.count() == 2 * len(cases)
    assert url_filters.judge(captures.limit(0), spark.createDataFrame(entries, kind)).count() == 0


def test_url_keys_keep_the_case_of_paths_and_cover_whole_domains(spark):
    keys = ["Host.net/Ads/", "open.net/Dir", "ROOT.net/", "zip", "Both.net/a/B", "both.net/a/B/"]
    entries = spark.createDataFrame([("ads", True, k, "add", "2024-01-01") for k in keys], "list_name string, blocks boolean, key string, action string, day string")
    cases = [
        ("http://host.net/Ads/x", "host.net/Ads/"), ("http://HOST.net/Ads/", "host.net/Ads/"), ("http://host.net/ads/x", None), ("http://open.net/Dir/x", "open.net/Dir/"),
        ("http://open.net/Dirt/x", None), ("http://root.net/any/x", "root.net/"), ("http://www.root.net/x", None), ("http://a.b.zip/x", "zip"), ("http://zip.net/x", None), ("http://both.net/a/B/c/", "both.net/a/B/"),
    ]
    captures = spark.createDataFrame([(i, u, "2024-02-01") for i, (u, _) in enumerate(cases)], "page_id long, url string, fetch_day string")
    found = {r["page_id"]: r["matched_key"] for r in url_filters.judge(captures, entries).collect()}
    assert [found[i] for i in range(len(cases))] == [key for _, key in cases]


def test_crc_of_id_is_crc_of_its_text(spark):
    from edugauge.llm.common import crc_of_id

    assert spark.createDataFrame([(12,)], "doc_id long").select(crc_of_id("doc_id")).first()[0] == zlib.crc32(b"12")
