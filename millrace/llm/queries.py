"""One registered query per operator, with production parameters and, where SQL can say it, a statement."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import embed, html, language, mixing, ngram, phrases, pieces, simhash, spelling, tokens, topk, toxicity, warc
from millrace.llm.common import load, prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return add


# Brute force in DuckDB; the links are walked from every vector, which small tables allow.
OP1_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT c.a AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id,
    c.a = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.a
"""


@query("op1_embedding_near_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(load(spark, sf_dir, "embeddings"), 0.95).withColumnRenamed("id", "vec_id")


# The digest is base32 of SHA-1: eight groups of 40 bits, read from the hex form.
OP2_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST(('0x' || substr(hex, CAST((i // 8) * 10 + 1 AS BIGINT), 10)) AS BIGINT)
    >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


@query("op2_warc", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_archive(load(spark, sf_dir, "pages"), revisit_bytes=0).withColumnRenamed("id", "page_id")


@query("op3_token_ids")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.token_files(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, with_ids=False)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.withColumnRenamed("id", "doc_id")


@query("op5_kneser_ney")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = ngram.train(docs.where(~held_out), order=3)
    found = ngram.scores(docs, model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    found = html.main_text(pages, html.train(pages))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS weight FROM s),
q AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT *, row_number() OVER o AS pos,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
    FROM q WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
t AS (SELECT source, source_size,
    coalesce(least(CAST(cap AS DOUBLE), (SELECT arg_min(level, pos) FROM l WHERE level <= ratio) * weight), 0) AS target,
    CAST(CAST('0x' || substr(md5('mix|' || coalesce('s' || source, 'n')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS u
    FROM l),
g AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS step,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) AS rank
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    CAST(least(floor(u + step * rank) - floor(u + step * (rank - 1)), 3) AS BIGINT) * size AS taken FROM g
"""


@query("op7_mix_sources", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    mixed = mixing.copies(docs, weights=(1, 2, 3), most=3, keep_rows=False)
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.round_trip(load(spark, sf_dir, "documents").select("doc_id", "text"), model, remembered=240_000)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_crc32",
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("same_text"),
    )


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), folds=5, held_out=0)
    found = toxicity.scored(docs, model, remembered=500_000)
    held_out = F.coalesce(toxicity.fold_of(F.col("row.doc_id"), 5) == 0, F.lit(False))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
        list_transform(q.e, lambda x: CAST(x AS DOUBLE)), list_transform(c.e, lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op10_exact_top_k", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), k=20, scale=64, query_every=20)


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text of code points below U+0800, in DuckDB: bytes and eight shifts behind each, folded."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    steps = f"flatten(list_transform({octets}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, CAST({steps} AS BIGINT[])), {fold}), 4294967295)"


# Two words are near if one of them without a letter is the other, or both without the letter at one place are the same.
OP11_SQL = f"""
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
u AS (SELECT name, run, count(*) AS times FROM r GROUP BY ALL),
h AS (SELECT run, times, CAST({crc32_sql("name || ':' || run")} AS BIGINT) AS h FROM u),
o AS (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS less
    FROM (SELECT word, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT d.word, w.word FROM d JOIN w ON w.word = d.less UNION SELECT w.word, d.word FROM d JOIN w ON w.word = d.less),
b AS (SELECT p.a, count(*) AS n_near, arg_min(p.b, (-w.n, p.b)) AS form, max(w.n) AS form_n FROM p JOIN w ON w.word = p.b GROUP BY p.a),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 2 * w.n THEN b.form END AS form,
    CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n FROM w LEFT JOIN b ON b.a = w.word),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM f JOIN c e ON e.word = f.word JOIN f z ON z.word = e.at AND z.form IS NULL
"""


@query("op11_spelling_variants", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"), every=97, shortest=5, least=3, factor=2)


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
z AS (SELECT lang, unnest(list_zip(w, w[2:], w[3:], w[4:])) AS t FROM s),
g AS (SELECT lang, t[1] AS phrase, 1 AS m FROM z UNION ALL SELECT lang, t[1] || ' ' || t[2], 2 FROM z WHERE t[2] IS NOT NULL
    UNION ALL SELECT lang, t[1] || ' ' || t[2] || ' ' || t[3], 3 FROM z WHERE t[3] IS NOT NULL
    UNION ALL SELECT lang, t[1] || ' ' || t[2] || ' ' || t[3] || ' ' || t[4], 4 FROM z WHERE t[4] IS NOT NULL),
f AS MATERIALIZED (SELECT lang, phrase, m, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM s GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1),
k AS (SELECT lang, phrase, m, f, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM c),
x AS (SELECT k.lang, k.phrase, k.f, k, a.f AS l, b.f AS r, (2000000::HUGEINT * k.f) // (a.f + b.f) AS score
    FROM k JOIN f a ON a.lang = k.lang AND a.phrase = array_to_string(w[:k], ' ')
    JOIN f b ON b.lang = k.lang AND b.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT lang, phrase, f AS a, arg_min(struct_pack(l, r, score), (score, k)) AS cut FROM x GROUP BY ALL),
o AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c d ON d.lang = c.lang AND d.m > c.m AND 100 * d.f >= 80 * c.f
    AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')),
r AS (SELECT lang, phrase, a, cut.l AS l, cut.r AS r, cut.score AS score, CAST(row_number() OVER
    (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS INTEGER) AS rank FROM b ANTI JOIN o USING (lang, phrase))
SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_phrases", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents"), words=4, least=30, share=80, factor=2_000_000, most=2000)


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, lower(text) AS low, coalesce({crc32_sql("CAST(doc_id AS VARCHAR)")} % 4 = 2, FALSE) AS held_out FROM documents),
s AS (SELECT row, string_split(' ' || trim(regexp_replace(low, '[^\pL\pM]+', ' ', 'g'), ' ') || ' ', '') AS l FROM d
    WHERE regexp_matches(low, '[\pL\pM]')),
z AS (SELECT row, unnest(list_zip(l, l[2:], l[3:])) AS t FROM s),
c AS (SELECT row, t[1] AS a, t[2] AS b, t[3] AS c FROM z),
g AS (SELECT row, a AS gram FROM c WHERE a <> ' ' UNION ALL SELECT row, a || b FROM c WHERE b IS NOT NULL
    UNION ALL SELECT row, a || b || c FROM c WHERE c IS NOT NULL AND b <> ' '),
n AS MATERIALIZED (SELECT row, gram, count(*) AS n FROM g GROUP BY row, gram),
t AS (SELECT d.lang, n.gram, sum(n.n) AS n FROM n JOIN d USING (row) WHERE NOT d.held_out AND d.lang IS NOT NULL GROUP BY d.lang, n.gram),
p AS MATERIALIZED (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank FROM t QUALIFY rank <= 300),
m AS (SELECT row, gram, row_number() OVER (PARTITION BY row ORDER BY n DESC, gram) AS rank FROM n QUALIFY rank <= 300),
a AS (SELECT m.row, k.lang, sum(coalesce(abs(m.rank - p.rank), 300)) AS away, 300 * count(*) AS most
    FROM m CROSS JOIN (SELECT DISTINCT lang FROM p) k LEFT JOIN p ON p.lang = k.lang AND p.gram = m.gram GROUP BY m.row, k.lang),
o AS (SELECT row, lang, away, most, row_number() OVER (PARTITION BY row ORDER BY away, lang) AS rank FROM a),
f AS (SELECT row, max(lang) FILTER (rank = 1) AS lang, max(away) FILTER (rank = 1) AS nearest,
    coalesce(max(away) FILTER (rank = 2), max(most)) AS second FROM o GROUP BY row)
SELECT d.doc_id, d.held_out, CASE WHEN regexp_matches(d.low, '\pL') THEN coalesce(f.lang, 'und') ELSE 'und' END AS lang_pred,
    CASE WHEN f.second > 0 AND regexp_matches(d.low, '\pL') THEN 1 - CAST(f.nearest AS DOUBLE) / CAST(f.second AS DOUBLE) ELSE 0 END AS score
FROM d LEFT JOIN f USING (row)
"""


@query("op13_language", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = language.predicted(docs, language.train(docs.where(~held_out))).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
