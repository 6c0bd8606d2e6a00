"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.llm import (
    chat_format,
    conversation_repair,
    decontamination,
    exact_dedup,
    html_text,
    mixing,
    packing,
    simhash,
    surrogates,
    token_alignment,
    topk,
    toxicity,
    warc,
)
from imagelab.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fate = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return fate.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
r AS (SELECT *, 2 * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio,
             1.5::DOUBLE * (SELECT CAST(sum(size) AS BIGINT) FROM d) AS budget FROM s),
level AS (
  SELECT DISTINCT ratio, budget - coalesce((SELECT CAST(sum(cap) AS BIGINT) FROM r f WHERE f.ratio < r.ratio), 0) AS free,
         (SELECT CAST(sum(weight) AS BIGINT) FROM r o WHERE o.ratio >= r.ratio) AS spread
  FROM r),
cut AS (SELECT * FROM level WHERE free / spread <= ratio ORDER BY ratio LIMIT 1),
t AS (SELECT r.source, source_size,
             CASE WHEN r.ratio < cut.ratio THEN cap::DOUBLE ELSE free * weight / spread END AS target
      FROM r, cut),
o AS (
  SELECT d.*, t.source_size, t.target,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - before))
          + greatest(0, least(size, floor(target) - before - source_size)) AS BIGINT) AS taken
FROM o
""")
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


CONTROL_WORDS = "</s>[INST] ok [/INST]"  # what both turns of the added conversation -1 say


@query(r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length('<s>[INST][/INST]</s>')
    + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS chars FROM c),
p AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn) AS prefix,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS last FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (last OR role = 'assistant') AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
""")
def op5_chat_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{CONTROL_WORDS}' AS text"
    )
    examples = chat_format.expand_prefixes(talks.unionByName(added))
    return chat_format.read_back(examples).withColumnRenamed("conversation", "conv_id")


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), added_tokens=True)
    return packed.withColumnRenamed("id", "doc_id")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
""")
def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return captures.select(
        F.col("metadata.page_id").cast("long").alias("page_id"),
        "response.payload_bytes",
        "response.payload_digest",
        F.col("response.type").alias("record_type"),
        F.col("metadata.refers_to").cast("long").alias("refers_to"),
    )


@query()
def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return near.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op7_max_score_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scorer = toxicity.fit_scorer(documents, table(spark, sf_dir, "labels"))
    return toxicity.scored(documents, scorer).withColumnRenamed("id", "doc_id")


@query()
def op1_html_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_articles(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


SURROGATE_KEY = b"key of the registered query"  # a real corpus takes a secret one


@query()
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, n_entities, entities): whole texts with surrogates; places are those in the new text."""
    rows = surrogates.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    places = F.transform("entities", lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end")))
    count = F.size("entities").cast("long").alias("n_entities")
    return rows.select(F.col("id").alias("doc_id"), "text", count, places.alias("entities"))


@query(r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
      lambda crc, byte: list_reduce(range(8), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
      4294967295::BIGINT), 4294967295::BIGINT) % 20 AS damage
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE damage WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE damage <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM d),
x AS (
  SELECT *, left(role, 1) AS c, role || ':' || text AS line,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
         WHEN min(n) OVER (PARTITION BY conv_id, role, text) < n THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM o),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (n > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
  FROM x GROUP BY conv_id),
r AS (  -- cheapest ways to each place of the role grammar: start, after system, after user, after assistant
  SELECT conv_id, 0::BIGINT AS n, {cost: 0, audit: '', body: []::VARCHAR[]} AS a0,
    NULL::STRUCT(cost INTEGER, audit VARCHAR, body VARCHAR[]) AS a1,
    {cost: 2, audit: 'I', body: ['user:']} AS a2, {cost: 4, audit: 'II', body: ['user:', 'assistant:']} AS a3
  FROM s
  UNION ALL
  SELECT conv_id, n, b0, b1, c2,
    list_min([b3, CASE WHEN c2 IS NOT NULL THEN {cost: c2.cost + 2, audit: c2.audit || 'I', body: c2.body || ['assistant:']} END])
  FROM (
    SELECT *, list_min([b2, CASE WHEN b0 IS NOT NULL THEN {cost: b0.cost + 2, audit: b0.audit || 'I', body: b0.body || ['user:']} END,
        CASE WHEN b1 IS NOT NULL THEN {cost: b1.cost + 2, audit: b1.audit || 'I', body: b1.body || ['user:']} END,
        CASE WHEN b3 IS NOT NULL THEN {cost: b3.cost + 2, audit: b3.audit || 'I', body: b3.body || ['user:']} END]) AS c2
    FROM (
      SELECT conv_id, n,
        {cost: a0.cost + 3, audit: a0.audit || 'D', body: a0.body} AS b0,
        list_min([CASE WHEN a1 IS NOT NULL THEN {cost: a1.cost + 3, audit: a1.audit || 'D', body: a1.body} END,
          CASE WHEN stays AND c = 's' THEN {cost: a0.cost + late, audit: a0.audit || 'K', body: a0.body || [line]} END]) AS b1,
        list_min([{cost: a2.cost + 3, audit: a2.audit || 'D', body: a2.body},
          CASE WHEN stays AND c = 'u' THEN {cost: u.cost + late, audit: u.audit || 'K', body: u.body || [line]} END,
          CASE WHEN stays THEN {cost: u.cost + 2 + late, audit: u.audit || 'R', body: u.body || ['user:' || text]} END]) AS b2,
        list_min([{cost: a3.cost + 3, audit: a3.audit || 'D', body: a3.body},
          CASE WHEN stays AND c = 'a' THEN {cost: a2.cost + late, audit: a2.audit || 'K', body: a2.body || [line]} END,
          CASE WHEN stays THEN {cost: a2.cost + 2 + late, audit: a2.audit || 'R', body: a2.body || ['assistant:' || text]} END]) AS b3
      FROM (
        SELECT r.*, x.* EXCLUDE (conv_id, n), r.n + 1 AS m, list_min([r.a0, r.a1, r.a3]) AS u,
          fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS late
        FROM r JOIN x ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND x.n = r.n + 1) y(conv_id, old, a0, a1, a2, a3, turn, role, text, copy, c, line, fault, before, n, u, stays, late)))),
b AS (SELECT r.conv_id, list_min([a0, a3]) AS best FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND n = n_rows),
f AS (SELECT DISTINCT conv_id FROM conversations)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.body, chr(10)), '')) AS repaired_sha256
FROM f LEFT JOIN s ON f.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN b ON f.conv_id IS NOT DISTINCT FROM b.conv_id
""")
def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


@query(r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
iw AS MATERIALIZED (SELECT DISTINCT item, l, array_to_string(w[s:s + l - 1], ' ') AS span FROM i),
p AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM iw)),
m AS MATERIALIZED (
  SELECT DISTINCT r, s, iw.l, item FROM p JOIN iw ON iw.span = array_to_string(w[s:s + p.l - 1], ' ')),
h AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + l)) AS place FROM m) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
""")
def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op12_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
