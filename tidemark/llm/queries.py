"""The registered queries of this subpackage and their SQL: thin callers of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, html_wrapper, lang_id, ngram_join, packing, pii, prefix_trie, quality, sentence_dedup, url_filter, warc, whitening
from tidemark.llm.common import crc_fold, scratch_dir, staged, table

#: The rules of op1.
RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op1_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark, table(spark, sf_dir, "pages"), RULES)


def op2_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tk")


def op4_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(spark, table(spark, sf_dir, "documents")).drop("tk")


def op5_sliding_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op6_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def op7_quality_fourier_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = staged(spark, quality.with_statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    model = quality.train(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), stats=stats)
    scored = quality.score(spark, stats, model)
    held_out = crc_fold("doc_id", quality.FOLDS) == quality.HELD_OUT
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(spark, table(spark, sf_dir, "documents")))


def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_fold("doc_id", 4) == 2
    found = lang_id.train_and_predict(spark, docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))


def op10_host_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(spark, table(spark, sf_dir, "pages"))


def op11_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "warc")
    warc.write_archive(spark, table(spark, sf_dir, "pages"), root)
    return warc.resolved(spark, warc.read_archive(spark, root))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark, table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


_SPACE = r"'[\x20\x09-\x0D]+'"

OP6_SQL = f"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), {_SPACE}, ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      ELSE [array_to_string(w, ' ')] END) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-6),
r AS (SELECT doc_id, doc_id AS class_id FROM documents UNION SELECT l.b, r.class_id FROM r JOIN l ON l.a = r.doc_id)
SELECT r.doc_id, min(class_id) AS class_id, (SELECT count(*) FROM l WHERE l.a = r.doc_id) AS n_links FROM r GROUP BY r.doc_id
"""


#: CRC-32 of the id as text, before the last inversion; 3988292384 is its polynomial.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: unicode(c)::BIGINT)),
    lambda x, c: list_reduce(list_prepend(xor(x, c), range(8)), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))"""

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, lang, xor({_CRC}, 4294967295) % 4 = 2 AS held_out,
    ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS t FROM documents),
p AS (SELECT doc_id, unnest(range(1, length(t) + 1)) AS i, t FROM d WHERE t <> '  '),
s AS (SELECT doc_id, i, unicode(substr(t, i, 1))::BIGINT AS x FROM p),
b AS (SELECT doc_id, i, CASE WHEN x = 32 THEN 1 ELSE x END AS x FROM s),
n AS (SELECT doc_id, x AS a, lead(x) OVER g AS b, lead(x, 2) OVER g AS c FROM b WINDOW g AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, a AS code FROM n WHERE a <> 1 UNION ALL SELECT doc_id, a * 2097152 + b FROM n WHERE b IS NOT NULL
    UNION ALL SELECT doc_id, a * 4398046511104 + b * 2097152 + c FROM n WHERE c IS NOT NULL AND b <> 1),
q AS (SELECT doc_id, code, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT doc_id, code, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, code) - 1 AS pos FROM q QUALIFY pos < 300),
l AS (SELECT lang, code, sum(n) AS n FROM q JOIN d USING (doc_id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
k AS (SELECT lang, code, row_number() OVER (PARTITION BY lang ORDER BY n DESC, code) - 1 AS pos FROM l QUALIFY pos < 300),
m AS (SELECT r.doc_id, z.lang, sum(coalesce(abs(r.pos - k.pos), 300)) AS far, count(*) * 300 AS worst
    FROM r CROSS JOIN (SELECT DISTINCT lang FROM k) z LEFT JOIN k ON k.lang = z.lang AND k.code = r.code GROUP BY ALL),
e AS (SELECT doc_id, arg_min(lang, struct_pack(far := far, lang := lang)) AS lang_pred, min(far) AS best, any_value(worst) AS worst FROM m GROUP BY doc_id),
f AS (SELECT doc_id, round(1 / sum(exp(8 * (1 - m.far / m.worst) - 8 * (1 - e.best / e.worst))), 6) AS score FROM m JOIN e USING (doc_id) GROUP BY doc_id)
SELECT doc_id, held_out, coalesce(lang_pred, 'und') AS lang_pred, coalesce(score, 0) AS score FROM d LEFT JOIN e USING (doc_id) LEFT JOIN f USING (doc_id)"""


OP11_SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, row_number() OVER g AS k, first_value(page_id) OVER g AS first_page FROM p
    WINDOW g AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, coalesce(url, '')))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN k > 1 AND payload_bytes >= 100 THEN first_page END AS refers_to FROM k"""

OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, '') AS role, octet_length(encode(coalesce(text, ''))) AS bytes,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos FROM d),
c AS (SELECT conv_id, max(pos) AS own, xor({_CRC.replace('doc_id', 'conv_id')}, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id),
x AS (SELECT c.conv_id, c.own, c.h, c.base, least(c.h, coalesce(b.own, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT x.conv_id, t.pos AS depth, digest, bytes FROM x JOIN t ON t.conv_id = x.base WHERE t.pos <= x.taken
    UNION ALL SELECT x.conv_id, x.taken + t.pos - x.h, digest, bytes FROM x JOIN t ON t.conv_id = x.conv_id WHERE t.pos > x.h),
n AS (SELECT conv_id, 0::BIGINT AS depth, '' AS node, 0::BIGINT AS bytes FROM c
    UNION ALL SELECT r.conv_id, r.depth, sha256(n.node || r.digest), r.bytes FROM n JOIN r ON r.conv_id = n.conv_id AND r.depth = n.depth + 1),
g AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM n GROUP BY depth, node),
p AS (SELECT g.*, up.node AS up, a.conv_id AS parent_conv_id FROM g LEFT JOIN n up ON up.conv_id = g.conv_id AND up.depth = g.depth - 1
    LEFT JOIN g a ON a.depth = up.depth AND a.node = up.node),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM p WHERE up IS NOT NULL GROUP BY ALL),
q AS (SELECT p.*, coalesce(k.n_children, 0) AS n_children FROM p LEFT JOIN k USING (depth, node)),
s AS (SELECT n.depth, n.node, count(*) FILTER (q.n_children = 0) AS n_leaves, CAST(sum((q.n_convs - 1) * q.bytes) AS BIGINT) AS saved_tokens
    FROM q JOIN n ON n.conv_id = q.conv_id AND n.depth <= q.depth GROUP BY ALL),
e AS (SELECT depth, node, sha256(string_agg(conv_id, ',' ORDER BY conv_id)) AS ends FROM (SELECT * FROM n QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY ALL)
SELECT q.conv_id, q.depth, q.parent_conv_id, q.n_convs, q.n_children, s.n_leaves, s.saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM q JOIN s USING (depth, node) LEFT JOIN e USING (depth, node)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op4_lsh_forest_join": OP4_SQL, "op6_streaming_exact_dedup": OP6_SQL, "op9_rank_order_language": OP9_SQL, "op11_sharded_warc": OP11_SQL, "op12_conversation_trie": OP12_SQL}
