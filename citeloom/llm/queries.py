"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import chat_format, decontaminate, dual_tree, exact_dedup, html_text, line_dedup, nbsvm, near_dedup, packing, poisson_mix, resample, secrets, toxic_gru


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.conversation_digests(chat_format.prefix_examples(turns))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|start|><|end|>') + 2
    + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n'))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op2_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nbsvm.score(docs, nbsvm.fit(docs, table(spark, sf_dir, "labels")))


def op3_toxic_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxic_gru.score(docs, toxic_gru.fit(docs, table(spark, sf_dir, "labels")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.visible_text(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[j:j + m - 1], ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS j FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, m, j, array_to_string(w[j:j + m - 1], ' ') AS k
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS j FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
), found AS (
  SELECT doc_id, j, m, item_id FROM places JOIN windows USING (m, k)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + m)) AS p FROM (SELECT DISTINCT doc_id, j, m FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS said FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


OP8_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n) * (SELECT sum(n) FROM sizes) / (SELECT sum(sqrt(n)) FROM sizes) / n AS rate FROM sizes
),
drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.rate,
    CAST('0x' || md5('17|' || d.doc_id)[:12] AS BIGINT) / 281474976710656.0 AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
),
cdf AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM rates, LATERAL (SELECT unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 24) AS BIGINT) + 1)) AS k)
),
counted AS (
  SELECT doc_id, text, lang, source, n_chars,
    (SELECT count(*) FROM cdf c WHERE c.source IS NOT DISTINCT FROM drawn.source AND c.p <= drawn.u) AS n_copies
  FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy,
  CAST('0x' || md5('17|' || doc_id || '|' || copy)[:12] AS BIGINT) AS shuffle_key
FROM counted, LATERAL (SELECT unnest(range(1, n_copies + 1)) AS copy)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents")).drop("text")


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
),
keys AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT lines.*, keys.key IS NOT NULL AND lines.doc_id <> keys.last AS gone FROM lines LEFT JOIN keys ON lines.key = keys.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op11_pack_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op12_dual_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.cluster_report(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(rounds: int, k: int = 8) -> str:
    """Lloyd's rounds written out: a CTE with the assignment and one with the new centroids for each."""
    near = """
far{r} AS MATERIALIZED (
  SELECT x.n, any_value(x.vec_id) AS vec_id, y.c, sum((x.v - y.v) * (x.v - y.v)) AS d FROM flat x JOIN cent{r} y USING (i) GROUP BY x.n, y.c
), near{r} AS MATERIALIZED (
  SELECT n, vec_id, c, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1
)"""
    mean = """
cent{s} AS MATERIALIZED (
  SELECT y.c, y.i, coalesce((m.s - ((m.s % m.k) + m.k) % m.k) // m.k, y.v) AS v
  FROM cent{r} y LEFT JOIN (SELECT c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS k FROM near{r} JOIN flat USING (n) GROUP BY c, i) m USING (c, i)
)"""
    steps = [near.format(r=0)]
    for r in range(rounds):
        steps += [mean.format(r=r, s=r + 1), near.format(r=r + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), flat AS MATERIALIZED (
  SELECT n, vec_id, unnest(v) AS v, unnest(range(1, 65)) AS i FROM kept
), cent0 AS MATERIALIZED (
  SELECT c, unnest(v) AS v, unnest(range(1, 65)) AS i
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < {k})
), {", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM near{rounds} JOIN (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS h FROM cent{rounds} GROUP BY c) USING (c)
"""


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH texts AS (
  SELECT true AS own, row_number() OVER () AS n, text FROM documents UNION ALL SELECT false, row_number() OVER (), text FROM benchmark
), words AS (
  SELECT own, n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS MATERIALIZED (
  SELECT own, n, f, count(*) AS k FROM (
    SELECT own, n, unnest(w) AS f FROM words
    UNION ALL SELECT own, n, w[j] || ' ' || w[j + 1] AS f FROM (SELECT own, n, w, unnest(range(1, len(w))) AS j FROM words)
  ) GROUP BY ALL
), bytes AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS (
  SELECT f, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, len(h) + 1, 2), lambda i: [CAST('0x' || h[i:i + 1] AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) % 10000 AS bucket
  FROM bytes
), placed AS MATERIALIZED (
  SELECT own, n, bucket, sum(k) AS k FROM features JOIN hashed USING (f) GROUP BY ALL
), sums AS (
  SELECT bucket, CAST(coalesce(sum(k) FILTER (own), 0) AS DOUBLE) AS s, CAST(coalesce(sum(k) FILTER (NOT own), 0) AS DOUBLE) AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000)))) AS BIGINT) AS g FROM sums
), weights AS (
  SELECT n, CAST(sum(k) AS BIGINT) AS n_features, CAST(floor(sum(k * g) / sum(k)) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE own GROUP BY n
), scored AS (
  SELECT d.doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || d.doc_id)[1:8] AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM (SELECT row_number() OVER () AS n, doc_id FROM documents) d JOIN (SELECT n, w FROM words WHERE own) w USING (n) LEFT JOIN weights USING (n)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_words >= 20) AS all_rows FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 25 * all_rows // 100 THEN r END AS rank FROM ranked
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_nbsvm_quality": op2_nbsvm_quality,
        "op3_toxic_gru": op3_toxic_gru,
        "op4_near_dedup": op4_near_dedup,
        "op5_html_text": op5_html_text,
        "op6_secret_scan": op6_secret_scan,
        "op7_decontaminate": op7_decontaminate,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_poisson_mix": op9_poisson_mix,
        "op10_line_dedup": op10_line_dedup,
        "op11_pack_cutting_stock": op11_pack_cutting_stock,
        "op12_dual_tree_lloyd": op12_dual_tree_lloyd,
        "op13_importance_resample": op13_importance_resample,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op7_decontaminate": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op9_poisson_mix": OP9_SQL, "op10_line_dedup": OP10_SQL, "op12_dual_tree_lloyd": _lloyd_sql(dual_tree.ROUNDS), "op13_importance_resample": OP13_SQL}
