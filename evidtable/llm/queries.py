"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, compression_quality, decontaminate, packing, pii, quality_rules, simhash, suffix_dedup, token_counts, warc
from .common import stage, table

CONTROL = "</s>[INST] ok [/INST]"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    return chat.read_back(stage(chat.format_trees(chat.linear_nodes(rows.unionByName(own))), "formatted"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_decontaminate, op2_pack, op3_suffix_dedup, op4_chat_format, op5_token_counts, op6_warc, op7_pii, op8_simhash, op9_quality, op10_quality_rules)
    return {f.__name__: f for f in every}


_WORDS1 = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS1} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS1} AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - least(10, len(w)), 0) + 2)) t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM q),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM d, ks, unnest(range(1, greatest(CAST(len(w) - k + 2 AS BIGINT), 1))) t(i)),
hit AS (SELECT r, i, dw.k, item FROM dw JOIN q ON dw.k = q.k AND dw.s = q.s),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r),
qn AS (SELECT row_number() OVER () AS qid, item, k, string_split(s, ' ') AS ws FROM q WHERE item IS NOT NULL),
wt AS (SELECT qid, item, k, unnest(ws) AS term, unnest(range(len(ws))) AS o FROM qn),
ps AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS p FROM d),
fr AS (SELECT term, count(*) AS f FROM ps GROUP BY term),
ra AS (SELECT qid, arg_min(o, 100 * coalesce(f, 0) + o) AS o, arg_min(term, 100 * coalesce(f, 0) + o) AS term FROM wt LEFT JOIN fr USING (term) GROUP BY qid),
st AS (SELECT qid, r, p - o AS s FROM ra JOIN ps USING (term)),
ok AS (SELECT st.qid, item, st.r, s FROM st JOIN wt ON st.qid = wt.qid JOIN ps ON ps.r = st.r AND ps.term = wt.term AND ps.p BETWEEN s + wt.o - {decontaminate.SLOP} AND s + wt.o + {decontaminate.SLOP}
  GROUP BY ALL HAVING count(DISTINCT wt.o) = max(wt.k)),
near AS (SELECT r, count(DISTINCT item) AS n_near FROM ok GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(it.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r) LEFT JOIN near USING (r)
"""

_ESC = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), ']', '&rsqb;')"

OP4_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length({_ESC.format("text")}) + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 17 WHEN 'assistant' THEN 9 ELSE 14 + length({_ESC.format("role")}) END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
o AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS owner FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((('0x' || substr(x, 1 + 5 * CAST(i // 4 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NULL OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NULL OR page_id = owner THEN NULL ELSE owner END AS refers_to
FROM o
"""

_POLICY_SQL = " OR ".join(f"({rule})" for _, rule in quality_rules.RULES)
_FAILED_SQL = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(quality_rules.RULES))

OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM w, unnest(range(1, greatest(len(w) - 3, 1))) t(i)),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM k WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT ({_POLICY_SQL}) AS kept, CAST({_FAILED_SQL} AS BIGINT) AS failed FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op4_chat_format": OP4_SQL, "op6_warc": OP6_SQL, "op10_quality_rules": OP10_SQL}
