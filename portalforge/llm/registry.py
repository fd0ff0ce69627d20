"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge.llm import decontam, language, lmscore, merkle, mixing, neardup, pii, quality, repair, substrings, tokencounts, topk, toxicity
from portalforge.llm.common import shared_dir, stored, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_probminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text after replacement, number of replaced values, and their kinds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.mask(docs, report="found")
    kinds = F.array_sort(F.transform(F.map_entries("found"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return out.select("doc_id", "text",
                      F.aggregate(F.map_values("found"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_replaced"),
                      F.array_join(kinds, ",").alias("kinds"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four change batches of the corpus, two of them delivered twice."""
    import uuid

    counted = stored(tokencounts.counted_documents(table(spark, sf_dir, "documents")), "token-counts")
    rollup = tokencounts.Rollup(spark, f"{shared_dir(spark)}/llm/rollup-{uuid.uuid4().hex}")
    batches = tokencounts.document_events(counted)
    for batch_id in [*batches, "2-copies", "4-revise"]:
        rollup.commit(batch_id, batches[batch_id])
    return rollup.totals()


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scores(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_probminhash_neardup": op2_probminhash_neardup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_pii_pseudonyms": op4_pii_pseudonyms,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op5_exact_topk": op5_exact_topk,
    "op8_source_mixing": op8_source_mixing,
    "op9_latent_decontamination": op9_latent_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_lm_scores": op11_lm_scores,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_WORDS = r"[^\x20\x09-\x0D]+"

_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _case(level: str) -> str:
    given = "".join(f" WHEN '{k}' THEN {w}" for k, w in mixing.WEIGHTS[level].items())
    return f"CAST(CASE {level}{given} ELSE 1 END AS HUGEINT)"


def _fill_sql(name: str, source: str, node: str, parents: str, level: str) -> str:
    """One tree level: children ordered by capacity per weight, full ones first."""
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
{name}_n AS (SELECT {node}, sum(capacity) AS capacity, any_value({_case(level)}) AS weight,
    any_value(parent_budget) AS parent_budget FROM {source} WHERE capacity > 0 GROUP BY {node}),
{name}_o AS (SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
    FROM {name}_n WINDOW w AS ({by} ORDER BY capacity::double / weight::double, {level})),
{name}_f AS (SELECT *, capacity * weight_left <= weight * (parent_budget - before) AS is_full FROM {name}_o),
{name}_b AS (SELECT {node}, CASE WHEN is_full THEN capacity ELSE
    (weight * (parent_budget - coalesce(sum(capacity) FILTER (WHERE is_full) OVER ({by}), 0)))
     // (sum(weight) FILTER (WHERE NOT is_full) OVER ({by})) END AS budget FROM {name}_f),
{name} AS (SELECT l.* EXCLUDE (parent_budget), coalesce(b.budget, 0) AS parent_budget
    FROM {source} l LEFT JOIN {name}_b b USING ({node}))"""


_MIX_SQL = f"""
WITH d AS (
  SELECT doc_id,
    'domain' || CAST(coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER), 0) % 3 AS VARCHAR) AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM d GROUP BY ALL
), root AS (
  SELECT *, tokens * {mixing.MAX_EPOCHS} AS capacity,
    least((sum(tokens) OVER ()) * {mixing.BUDGET_PERCENT} // 100,
          (sum(tokens) OVER ()) * {mixing.MAX_EPOCHS}) AS parent_budget FROM leaves
), {_fill_sql("a", "root", "domain", "", "domain")},
{_fill_sql("b", "a", "domain, lang", "domain", "lang")},
{_fill_sql("c", "b", "domain, lang, source", "domain, lang", "source")},
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN parent_budget // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN parent_budget % tokens ELSE 0 END AS rest FROM c
), r AS (
  SELECT d.*, whole, rest, md5(concat_ws(':', '{mixing.SEED}', CAST(whole + 1 AS VARCHAR), CAST(doc_id AS VARCHAR))) AS k
  FROM d JOIN plan USING (domain, lang, source)
), o AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id, n_tokens
                                ROWS UNBOUNDED PRECEDING) AS upto FROM r
)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(e AS INTEGER) AS epoch
FROM (SELECT *, unnest(range(1, CAST(whole AS BIGINT) + 1 + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS e FROM o)
"""

_LETTERS = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
_TOKENS_SQL = rf"""
WITH d AS (
  SELECT source, lang, doc_id IS NOT NULL AND text IS NOT NULL
      AND doc_id > min(doc_id) OVER (PARTITION BY text) AS is_copy,
    coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS n0,
    coalesce(len(regexp_extract_all(text, '{tokencounts.TOKENIZERS["words-2"]}')), 0) AS n1,
    coalesce(len(regexp_extract_all(text, '{_LETTERS}')), 0) AS nr
  FROM documents
), t AS (
  SELECT source, lang, 'words-1' AS tokenizer, nr AS n FROM d WHERE NOT is_copy
  UNION ALL SELECT source, lang, 'words-2', n1 FROM d WHERE NOT is_copy
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM t GROUP BY ALL HAVING count(*) <> 0 OR sum(n) <> 0
"""

def _crc32(text: str) -> str:
    """crc32 of a text of ASCII characters, bit by bit."""
    shift = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda p: ascii(substr({text}, p, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {shift}), 4294967295)"


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


# Trees are climbed node by node; every leaf then walks up its own path.
_MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN ({_crc32("doc_id::VARCHAR")}) % 3 = 0
      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM d
), up AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), max((n + 7) // 8)
  FROM up WHERE n > 1 GROUP BY tree, level, pos // 8
), sub AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, h, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), max((n + 7) // 8) FROM top WHERE n > 1 GROUP BY level, pos // 8
), nodes AS (
  SELECT tree, level, pos, h, n FROM up UNION ALL SELECT '', level, pos, h, n FROM top
), runs AS (
  SELECT tree, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), walk AS (
  SELECT tree AS home, pos AS leaf_pos, tree, 0 AS level, pos, coalesce(changed, leaf) AS folded, '' AS proof, n FROM placed
  UNION ALL
  SELECT w.home, w.leaf_pos, CASE WHEN w.n = 1 THEN '' ELSE w.tree END, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
    CASE WHEN w.n = 1 THEN s.pos ELSE w.pos // 8 END,
    CASE WHEN w.n = 1 THEN w.folded ELSE
      sha256(array_to_string(r.hs[:w.pos % 8], '') || w.folded || array_to_string(r.hs[w.pos % 8 + 2:], '')) END,
    CASE WHEN w.n = 1 THEN w.proof ELSE
      w.proof || array_to_string(r.hs[:w.pos % 8], '') || array_to_string(r.hs[w.pos % 8 + 2:], '') END,
    CASE WHEN w.n = 1 THEN s.n ELSE (w.n + 7) // 8 END
  FROM walk w LEFT JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.pos // 8
    LEFT JOIN sub s ON s.tree = w.tree
  WHERE w.n > 1 OR w.tree <> ''
)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,
  w.folded = t.h AS verified
FROM placed p JOIN walk w ON w.home = p.tree AND w.leaf_pos = p.pos AND w.tree = '' AND w.n = 1
JOIN sub s ON s.tree = p.tree JOIN top t ON t.n = 1
"""

# Row by row: the cheapest, then least audit of getting to each state.
_REPAIR_SQL = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS ckey FROM conversations
), kinds AS (SELECT *, ({_crc32("ckey")}) % 20 AS kind FROM k),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), faults AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS ini,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '.' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS pair
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
), ins(q, q2, cost, audit, txt) AS (
  VALUES ('e', 'e', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('e', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'), ('a', 'u', 3, 'I', chr(10) || 'user:'),
    ('u', 'a', 3, 'I', chr(10) || 'assistant:'), ('e', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), row_edges AS (
  SELECT f.conv_id, f.pos, e.q, e.q2,
    e.cost + CASE WHEN e.op <> 'D' AND fault = 't' THEN 3 ELSE 0 END AS cost, e.op,
    CASE e.op WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
      ELSE chr(10) || CASE e.q2 WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text END AS txt
  FROM faults f JOIN (VALUES ('e', 'e', 4, 'D', ''), ('s', 's', 4, 'D', ''), ('u', 'u', 4, 'D', ''), ('a', 'a', 4, 'D', ''),
    ('e', 's', 0, 'K', 's'), ('e', 'u', 0, 'K', 'u'), ('s', 'u', 0, 'K', 'u'), ('a', 'u', 0, 'K', 'u'), ('u', 'a', 0, 'K', 'a'),
    ('e', 'u', 3, 'R', ''), ('s', 'u', 3, 'R', ''), ('a', 'u', 3, 'R', ''), ('u', 'a', 3, 'R', '')) e(q, q2, cost, op, ini)
  ON (e.op = 'D' OR f.fault NOT IN ('b', 'd')) AND (e.op <> 'K' OR e.ini = f.ini)
), best AS (
  SELECT conv_id, 0::BIGINT AS pos, 'e' AS q, {{'cost': 0, 'audit': '', 'txt': ''}} AS b FROM counts
  UNION ALL
  SELECT x.conv_id, x.pos + 1, r.q2,
    min({{'cost': x.b.cost + i.cost + r.cost, 'audit': x.b.audit || i.audit || r.op, 'txt': x.b.txt || i.txt || r.txt}})
  FROM best x JOIN ins i ON i.q = x.q
    JOIN row_edges r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.pos = x.pos + 1 AND r.q = i.q2
  GROUP BY x.conv_id, x.pos, r.q2
), done AS (
  SELECT x.conv_id, min({{'cost': x.b.cost + i.cost, 'audit': x.b.audit || i.audit, 'txt': x.b.txt || i.txt}}) AS b
  FROM best x JOIN counts c ON c.conv_id IS NOT DISTINCT FROM x.conv_id AND c.n = x.pos
    JOIN ins i ON i.q = x.q AND i.q2 IN ('e', 'a')
  GROUP BY x.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(d.b.cost, 0)::BIGINT AS cost,
  coalesce(d.b.audit, '') AS audit, sha256(coalesce(substr(d.b.txt, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE = {
    "op5_exact_topk": _TOPK_SQL,
    "op8_source_mixing": _MIX_SQL,
    "op10_token_counts": _TOKENS_SQL,
    "op12_conversation_repair": _REPAIR_SQL,
    "op13_merkle_manifest": _MERKLE_SQL,
}
