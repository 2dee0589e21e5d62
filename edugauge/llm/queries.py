"""Registered queries of the corpus operators, each next to its DuckDB text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edugauge.llm import bpe, exact_dedup, language, line_dedup, manifest, mixing, ngram_join, resharding, topk_join, toxicity, url_filters, vector_codes, winnowing
from edugauge.llm.common import ascii_lower, broadcast_if_small, crc_of_id, quoted, store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# ---- 1: mixing -------------------------------------------------------------------------------------------------------

#: Equal shares for the twenty sources of the corpus, one epoch.
MIX_WEIGHTS = {f"src{i}": 1.0 for i in range(20)}
MIX_SEED = 17

OP1_SQL = f"""
WITH d AS (SELECT *, CASE WHEN source IN ({", ".join(f"'{s}'" for s in MIX_WEIGHTS)}) THEN source END AS listed,
                  coalesce(strlen(text), 0) + 1 AS size,
                  CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
           FROM documents),
     s AS (SELECT listed, sum(size) AS size FROM d WHERE listed IS NOT NULL GROUP BY listed),
     r AS (SELECT listed, CAST((SELECT sum(size) FROM s) AS DOUBLE) / (SELECT count(*) FROM s) / CAST(size AS DOUBLE) AS rate FROM s
           UNION ALL SELECT NULL, 1.0),
     p AS (SELECT listed, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM r, range(0, 400) AS t(k)),
     c AS (SELECT listed, k, sum(p) OVER (PARTITION BY listed ORDER BY k) AS step FROM p),
     n AS (SELECT d.*, (SELECT count(*) FROM c WHERE c.listed IS NOT DISTINCT FROM d.listed AND c.step <= d.u) AS copies FROM d)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy, CAST(copies AS INTEGER) AS copies,
       md5('{MIX_SEED}+:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(0, copies)) AS copy FROM n WHERE copies > 0)
"""


@query("op1_mix_sources", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources to equal shares of bytes, the mixture as large as the corpus."""
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, epochs=1.0, seed=MIX_SEED)


# ---- 6: exact dedup --------------------------------------------------------------------------------------------------

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {LOWER_SQL} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d
"""


@query("op6_exact_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays for it."""
    return exact_dedup.mark(table(spark, sf_dir, "documents")).drop("fp")


# ---- 9: line dedup ---------------------------------------------------------------------------------------------------

OP9_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
     m AS (SELECT k.*, f.first_id IS NOT NULL AND k.doc_id > f.first_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op9_line_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a document of a smaller id holds."""
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"), min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", sha(F.col("kept")).alias("kept_sha256"))


# ---- 10: URL filters -------------------------------------------------------------------------------------------------

FIRST_DAY, DAYS = "2024-01-01", 730
#: Lists by number: name, whether it blocks.
LISTS = (("ads", True), ("adult", True), ("trusted", False))
#: Dated events of each key, in turn ``add`` and ``remove``.
EVENTS = 4


def _draw(most: int, *parts: Column | str) -> Column:
    text = F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % most).cast("int")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with a fetch day drawn from the hash of their id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), _draw(DAYS, "fetch:", F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    return table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetch_day"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for every host, parent domain and directory of the captures, drawn from the key's hash."""
    url = F.col("url")
    keys = pages.select(url_filters.host_of(url).alias("h"), url_filters.directory_of(url).alias("d")).filter("h is not null").distinct()
    keys = keys.select(F.explode(url_filters.covering_keys(F.col("h"), F.col("d"), widest=False)).alias("key")).distinct()
    lists = F.array(*[F.struct(F.lit(n).alias("list_name"), F.lit(b).alias("blocks")) for n, b in LISTS])
    keys = keys.withColumn("list", F.element_at(lists, _draw(len(LISTS), "list:", F.col("key")) + 1))
    events = keys.select("key", "list.list_name", "list.blocks", F.explode(F.sequence(F.lit(0), F.lit(EVENTS - 1))).alias("i"))
    return events.select(
        "list_name", "blocks", "key", F.when(F.col("i") % 2 == 0, "add").otherwise("remove").alias("action"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _draw(DAYS, "entry:", F.col("key"), ":", F.col("i"))).alias("day"),
    )


def _draw_sql(most: int, text: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {most} AS INTEGER)"


_URL = url_filters.URL.replace("'", "''")
OP10_SQL = f"""
WITH c AS (SELECT page_id, url, DATE '{FIRST_DAY}' + {_draw_sql(DAYS, "'fetch:' || coalesce(CAST(page_id AS VARCHAR), '')")} AS fetch_day,
                  regexp_replace(lower(regexp_extract(url, '{_URL}', 1)), '\\.$', '') AS host, regexp_extract(regexp_extract(url, '{_URL}', 2), '^(/(?:[^/]*/)*)', 1) AS path
           FROM pages),
     c2 AS (SELECT *, CASE WHEN path = '' THEN '/' ELSE path END AS directory FROM c),
     sites AS (SELECT DISTINCT host, directory, string_split(host, '.') AS labels,
                      CASE WHEN directory = '/' THEN [] ELSE string_split(trim(directory, '/'), '/') END AS steps
               FROM c2 WHERE host IS NOT NULL AND host <> ''),
     cover AS (SELECT DISTINCT host, directory, unnest(list_concat(
                   [array_to_string(labels[i:], '.') FOR i IN range(1, greatest(len(labels), 2))],
                   [host || '/' || array_to_string(steps[:i], '/') || '/' FOR i IN range(1, len(steps) + 1)])) AS key FROM sites),
     keys AS (SELECT DISTINCT key, {_draw_sql(len(LISTS), "'list:' || key")} AS n FROM cover),
     events AS (SELECT key, {"CASE n " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(LISTS)) + " END"} AS list_name,
                       {"CASE n " + " ".join(f"WHEN {i} THEN {str(b).upper()}" for i, (_, b) in enumerate(LISTS)) + " END"} AS blocks,
                       i % 2 = 1 AS removes, DATE '{FIRST_DAY}' + {_draw_sql(DAYS, "'entry:' || key || ':' || i")} AS day
                FROM keys, range(0, {EVENTS}) AS t(i)),
     daily AS (SELECT list_name, blocks, key, day, NOT bool_or(removes) AS active FROM events GROUP BY ALL),
     changes AS (SELECT * FROM (SELECT *, lag(active) OVER (PARTITION BY list_name, key ORDER BY day) AS before FROM daily) WHERE active <> coalesce(before, FALSE)),
     valid AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list_name, key ORDER BY day) AS until FROM changes) WHERE active),
     hits AS (SELECT c2.page_id, c2.url, c2.fetch_day, v.key, v.blocks, v.list_name, v.day AS valid_from
              FROM c2 JOIN cover USING (host, directory) JOIN valid v USING (key)
              WHERE v.day <= c2.fetch_day AND (v.until IS NULL OR c2.fetch_day < v.until)),
     best AS (SELECT page_id, url, key, blocks, list_name, valid_from,
                     row_number() OVER (PARTITION BY page_id, url ORDER BY length(key) DESC, blocks DESC, key DESC, list_name, valid_from) AS n
              FROM hits QUALIFY n = 1)
SELECT c2.page_id, c2.url, strftime(c2.fetch_day, '%Y-%m-%d') AS fetch_day, coalesce(best.blocks, FALSE) AS blocked, best.key AS matched_key,
       best.list_name, strftime(best.valid_from, '%Y-%m-%d') AS valid_from
FROM c2 LEFT JOIN best ON best.page_id IS NOT DISTINCT FROM c2.page_id AND best.url IS NOT DISTINCT FROM c2.url
"""


@query("op10_url_filters", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active on its fetch day."""
    pages = captures(spark, sf_dir)
    judged = url_filters.judge(pages, list_entries(pages))
    return judged.select("page_id", "url", F.col("fetch_day").cast("string").alias("fetch_day"), "blocked", "matched_key", "list_name", F.col("valid_from").cast("string").alias("valid_from"))


# ---- 2: byte-level BPE -----------------------------------------------------------------------------------------------


def vocabulary(spark: SparkSession) -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of the public 50k vocabulary."""
    import public_tokenizers

    return bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ranks, pattern = vocabulary(spark)
    decoded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    return decoded.select("doc_id", bpe.token_count("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))


# ---- 3: toxicity -----------------------------------------------------------------------------------------------------


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of the labelled ones that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id("doc_id") % 5 == 0
    model = toxicity.fit(docs, labels, held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# ---- 4: sharding -----------------------------------------------------------------------------------------------------

#: The corpus lies in so many shards, by the hash of the text; equal texts lie together.
OLD_SHARDS, NEW_SHARDS = 12, 16


@query("op4_resharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from twelve shards by text hash to sixteen of equal row counts, read from the rewritten files."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    moved = resharding.reshard(docs.select("doc_id", "text"), crc % OLD_SHARDS, NEW_SHARDS)
    return moved.select(
        "doc_id", resharding.size_of(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# ---- 5: language ID --------------------------------------------------------------------------------------------------


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by centroids of the ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 3 == 1
    model = language.fit(docs, held_out)
    named = language.predict(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


# ---- 7: winnowing ----------------------------------------------------------------------------------------------------


@query("op7_winnowing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, next to those of its edited text and of the next document."""
    return winnowing.compare_with_edits(table(spark, sf_dir, "documents"))


# ---- 8: n-gram Jaccard join ------------------------------------------------------------------------------------------

OP8_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                  ELSE [array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)] END) AS shingle FROM w),
     n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
     r AS (SELECT doc_id, doc_id AS reached FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached),
     c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, (SELECT count(*) FROM l WHERE l.a = n.doc_id) AS n_links
FROM n JOIN c ON c.doc_id = n.doc_id
"""


@query("op8_ngram_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id that links of similar shingle sets reach."""
    return ngram_join.link(table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


# ---- 11: vector code compression -------------------------------------------------------------------------------------

PARTS, ENTRIES, ROUNDS, CODE_SCALE = 16, 64, 2, 256

_WHOLE_SQL = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _assign_sql(book: str) -> str:
    return f"""SELECT uid, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance
               FROM (SELECT p.uid, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS distance
                     FROM p JOIN {book} b ON b.part = p.part) GROUP BY uid, part"""


def _moved_sql(book: str, assigned: str) -> str:
    return f"""SELECT part, entry, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
                   SELECT part, entry, list(mean ORDER BY place) AS x FROM (
                       SELECT part, entry, place, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS mean
                       FROM (SELECT a.part, a.entry, generate_subscripts(p.x, 1) AS place, unnest(p.x) AS c FROM {assigned} a JOIN p USING (uid, part))
                       GROUP BY part, entry, place) GROUP BY part, entry) m USING (part, entry)"""


OP11_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS uid, vec_id, label, [CAST(floor({CODE_SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
                        FROM embeddings WHERE {_WHOLE_SQL}),
     p AS MATERIALIZED (SELECT uid, vec_id, part, x[(part * len(x)) // {PARTS} + 1:((part + 1) * len(x)) // {PARTS}] AS x FROM v, range(0, {PARTS}) AS t(part)),
     first AS (SELECT uid, row_number() OVER (ORDER BY vec_id, x) - 1 AS entry FROM v QUALIFY entry < {ENTRIES}),
     b0 AS MATERIALIZED (SELECT part, entry, x FROM p JOIN first USING (uid)),
     a0 AS MATERIALIZED ({_assign_sql("b0")}),
     b1 AS MATERIALIZED ({_moved_sql("b0", "a0")}),
     a1 AS MATERIALIZED ({_assign_sql("b1")}),
     b2 AS MATERIALIZED ({_moved_sql("b1", "a1")}),
     a2 AS MATERIALIZED ({_assign_sql("b2")}),
     e AS (SELECT uid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance) AS error FROM a2 GROUP BY uid)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(coalesce(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry), '')) FROM b2) AS codebooks_sha256
FROM v JOIN e USING (uid)
"""


@query("op11_vector_codes", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code by codebooks of 16 parts with 64 entries each."""
    vectors = table(spark, sf_dir, "embeddings")
    book = vector_codes.fit(vectors, "vec_id", "embedding", PARTS, ENTRIES, ROUNDS, CODE_SCALE)
    coded = store(vector_codes.encode(vectors.select("vec_id", "label", "embedding"), book, "embedding"), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(broadcast_if_small(store(by_label, "label_errors"), 32), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", sha(F.lit(book.text())).alias("codebooks_sha256"))


# ---- 12: exact top-k search ------------------------------------------------------------------------------------------

TOP_K, QUERY_STEP, PRODUCT_SCALE = 20, 20, 64

OP12_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS uid, vec_id, [floor({PRODUCT_SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings WHERE {_WHOLE_SQL}),
     s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id, c.uid AS other, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda t: t[1] * t[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON c.uid <> q.uid WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST, other) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP_K}
"""


@query("op12_voronoi_topk", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty rows of the largest inner product with every twentieth vector, among all rows."""
    return topk_join.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, TOP_K, PRODUCT_SCALE)


# ---- 13: Merkle manifest ---------------------------------------------------------------------------------------------

#: Levels that the text reaches up to, for trees of a group and of the groups; a group of more than 8 ** 7 rows needs more.
_TREE_LEVELS = 7


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes ``{name}`` by level of the trees over ``leaves (grp, place, h)``."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT grp, place, h FROM {leaves})"]
    for level in range(_TREE_LEVELS):
        parts.append(
            f"{name}{level + 1} AS MATERIALIZED (SELECT grp, place // 8 AS place, sha256(string_agg(h, '' ORDER BY place)) AS h FROM {name}{level} "
            f"WHERE grp IN (SELECT grp FROM {name}{level} GROUP BY grp HAVING count(*) > 1) GROUP BY grp, place // 8)"
        )
        parts.append(
            f"{name}{level}_run AS MATERIALIZED (SELECT a.grp, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l, "
            f"coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r FROM {name}{level} a JOIN {name}{level} b ON b.grp = a.grp AND b.place // 8 = a.place // 8 "
            f"WHERE a.grp IN (SELECT grp FROM {name}{level} GROUP BY grp HAVING count(*) > 1) GROUP BY a.grp, a.place)"
        )
    every = " UNION ALL ".join(f"SELECT {level} AS level, grp, place, h FROM {name}{level}" for level in range(_TREE_LEVELS + 1))
    parts.append(f"{name}_root AS MATERIALIZED (SELECT grp, arg_max(h, level) AS root FROM ({every}) WHERE place = 0 GROUP BY grp)")
    return ", ".join(parts)


def _fold_sql(name: str, source: str, out: str) -> str:
    """``source (id, grp, place, proof, claim)`` moved up the trees ``name``."""
    parts, last = [], source
    for level in range(_TREE_LEVELS):
        this = f"{out}{level + 1}" if level < _TREE_LEVELS - 1 else out
        parts.append(
            f"{this} AS MATERIALIZED (SELECT s.id, s.grp, s.place // 8 AS place, s.proof || coalesce(r.l || r.r, '') AS proof, "
            f"CASE WHEN r.grp IS NULL THEN s.claim ELSE sha256(r.l || s.claim || r.r) END AS claim FROM {last} s LEFT JOIN {name}{level}_run r ON r.grp = s.grp AND r.place = s.place)"
        )
        last = this
    return ", ".join(parts)


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


#: crc32 of a text of digits: eight shifts a character.
_CRC_SQL = (
    "xor(4294967295, list_reduce(list_concat([4294967295], flatten([[CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])), "
    "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"
)
OP13_SQL = f"""
WITH raw AS MATERIALIZED (SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
                 CASE WHEN {_CRC_SQL} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf_sql("text")} END AS claim FROM documents),
     d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, leaf, claim, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM raw),
     leaves AS (SELECT grp, place, leaf AS h FROM d),
     {_tree_sql("n", "leaves")},
     tops AS (SELECT 0 AS grp, grp AS place, root AS h FROM n_root),
     {_tree_sql("t", "tops")},
     f0 AS (SELECT id, grp, place, '' AS proof, claim FROM d),
     {_fold_sql("n", "f0", "f")},
     g0 AS (SELECT f.id, 0 AS grp, d.grp AS place, f.proof, f.claim FROM f JOIN d USING (id)),
     {_fold_sql("t", "g0", "g")}
SELECT d.doc_id, d.leaf, n_root.root AS subroot, t_root.root AS root, sha256(g.proof) AS proof_sha256, g.claim AS folded_root, g.claim = t_root.root AS verified
FROM d JOIN g USING (id) JOIN n_root ON n_root.grp = d.grp CROSS JOIN t_root
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; a third of them is verified as a copy in lower case."""
    docs = table(spark, sf_dir, "documents")
    received = {c: quoted(c) for c in manifest.FIELDS} | {"text": F.when(crc_of_id("doc_id") % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))}
    proved = manifest.manifest(docs, claim=manifest.leaf(list(received.values())))
    checked = proved.withColumn("folded_root", manifest.folded("claim"))
    return checked.select("doc_id", "leaf", "subroot", "root", manifest.digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
