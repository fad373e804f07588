"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import (ann_forest, divergence, exact_dedup, fim_frames, html_extract, mixing, near_dedup, ngram_join, packing,
                           quality, token_files, toxicity, warc_archive)
from duelframe.llm.common import table
from duelframe.session import scratch_path

MIX_REPEATS = 2.0
TOKEN_END, PACK_END, PACK_SIZE = 2, 1, 2048


def tokenizer_path() -> str:
    """The vocabulary file, on every machine that runs tasks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("dfx_main").alias("text"), F.char_length("dfx_main").cast("long").alias("n_chars"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), repeats=MIX_REPEATS)
    return out.select("doc_id", "source", F.col("dfx_pass").alias("pass"), F.col("dfx_position").cast("long").alias("position"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.col("dfx_held").alias("held_out"), F.col("dfx_score").alias("score"),
                      (F.col("dfx_score") >= 0.5).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc_archive.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc_archive.read_records(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_dedup(table(spark, sf_dir, "documents"), width=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    index = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path(), TOKEN_END)
    out = token_files.read_documents(spark, folder, index)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packed(docs: DataFrame) -> DataFrame:
    out = packing.pack(docs, tokenizer_path(), PACK_END, PACK_SIZE)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), width=3, percent=90)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fim_frames.write_frames(table(spark, sf_dir, "documents"))
    return fim_frames.digests(fim_frames.fill_in_middle(store))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n,
    ('0x' || substr(md5('b1|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {mixing.BLOCKS} AS block FROM documents),
c AS (SELECT source, block, sum(n)::BIGINT AS n FROM d GROUP BY ALL),
s AS (SELECT source, sum(n)::BIGINT AS tokens FROM c GROUP BY ALL),
t AS (SELECT max(tokens)::DOUBLE AS top, min(tokens)::DOUBLE AS least FROM s WHERE tokens > 0),
a AS (SELECT top, CASE WHEN top = least THEN 0.0 ELSE round(greatest(0, 1 + ln({MIX_REPEATS}) / ln(least / top)), 9) END AS alpha FROM t),
z AS (SELECT sum(pow(tokens / top, alpha)) AS whole FROM s, a WHERE tokens > 0),
q AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(pow(tokens / top, alpha) / whole * (top * whole))::BIGINT ELSE 0 END AS quota
    FROM s, a, z),
p AS (SELECT c.source, c.block, c.n, q.tokens, q.quota,
    unnest(range(1, 1 + CASE WHEN q.tokens > 0 THEN ceil(q.quota::DOUBLE / q.tokens)::BIGINT ELSE 1 END)) AS pass
    FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source),
h AS (SELECT *, ('0x' || substr(md5('1|' || coalesce(source, '') || '|' || pass || '|' || block), 1, 8))::BIGINT AS o FROM p),
w AS (SELECT *, sum(n) OVER (PARTITION BY source, pass ORDER BY o, block ROWS UNBOUNDED PRECEDING) - n AS before,
    row_number() OVER (PARTITION BY source, pass ORDER BY o, block) AS r FROM h)
SELECT d.doc_id, d.source, w.pass::INTEGER AS pass, ((w.pass - 1) * {mixing.BLOCKS} + w.r - 1)::BIGINT AS position
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source AND d.block = w.block
WHERE w.tokens <= w.quota - (w.pass - 1) * w.tokens OR w.before < w.quota - (w.pass - 1) * w.tokens
"""

OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN head END AS refers_to FROM g
"""

OP7_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.UPPER.lower()}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""

_LOWER = f"translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.UPPER.lower()}')"

OP11_SQL = f"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS (SELECT lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= {divergence.MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v) AS p FROM f),
l AS (SELECT lang, term, sum(n)::HUGEINT AS n, any_value(v) AS v FROM f GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // ((sum(n) OVER (PARTITION BY lang))::HUGEINT + 5 * v) AS q FROM l),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0)::BIGINT AS value
    FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM s WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) END AS g FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
b AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM b JOIN n a ON a.doc_id = x JOIN n c ON c.doc_id = y WHERE 100 * o >= 90 * (a.n + c.n - o)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.other = l.x)
SELECT n.doc_id, n.n AS n_shingles, min(r.other) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY ALL
"""

OP13_SQL = f"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
    sha256('{fim_frames.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
b AS (SELECT *, len(u)::BIGINT AS n, [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT for i in range(4)] AS r FROM a),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS i, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS j FROM b),
p AS (SELECT doc_id, t, n, coalesce(array_to_string(u[1:i], ''), '') AS pre, coalesce(array_to_string(u[i + 1:j], ''), '') AS mid,
    coalesce(array_to_string(u[j + 1:n], ''), '') AS suf,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= {fim_frames.RATE} THEN 'plain'
        WHEN r[4] % 100 < {fim_frames.SPM} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_html_extraction": (op1_html_extraction, None),
    "op2_source_mixing": (op2_source_mixing, OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_quality_classifier": (op4_quality_classifier, None),
    "op5_warc_archive": (op5_warc_archive, OP5_SQL),
    "op6_minhash_near_dedup": (op6_minhash_near_dedup, None),
    "op7_exact_dedup": (op7_exact_dedup, OP7_SQL),
    "op8_nearest_neighbours": (op8_nearest_neighbours, None),
    "op9_token_files": (op9_token_files, None),
    "op10_sequence_packing": (op10_sequence_packing, None),
    "op11_source_divergence": (op11_source_divergence, OP11_SQL),
    "op12_ngram_join": (op12_ngram_join, OP12_SQL),
    "op13_fill_in_middle": (op13_fill_in_middle, OP13_SQL),
}
