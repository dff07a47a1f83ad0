"""The registered queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from consolida.llm import alignment, conversations, decontamination, exact_dedup, html_text, importance, jaccard_join, language_id, ledger, licenses, packing, secrets, suffix_tree
from consolida.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), slop=1)
    return decontamination.digest(found)


def op5_rule_bitmask_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.report(read(spark, sf_dir, "documents"))


def op6_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(read(spark, sf_dir, "documents")))


def op7_html_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_language_bitmasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.cross_identify(read(spark, sf_dir, "documents"))


def op10_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations")
    rows = conversations.ordered(conversations.damaged(conversations.whole(table)))
    return conversations.digest(conversations.repair(rows), table)


QUERIES: dict[str, Query] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_rule_bitmask_ledger": op5_rule_bitmask_ledger,
    "op6_license_notices": op6_license_notices,
    "op7_html_minimum_cut": op7_html_minimum_cut,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_language_bitmasks": op9_language_bitmasks,
    "op10_secret_randomness": op10_secret_randomness,
    "op11_token_alignment": op11_token_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS grams FROM w),
e AS (SELECT doc_id, unnest(grams) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN s sx ON sx.doc_id = x JOIN s sy ON sy.doc_id = y WHERE 100 * c >= 90 * (len(sx.grams) + len(sy.grams) - c)),
b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(id, m) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, b.y FROM r JOIN b ON b.x = r.m)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, min(m) AS component_id FROM s JOIN r ON r.id = s.doc_id GROUP BY 1, 2"""

_LEDGER_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS bare, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM d) GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(bare) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines, length(regexp_replace(bare, '\P{Lu}+', '', 'g')) AS n_upper, length(regexp_replace(bare, '\P{L}+', '', 'g')) AS n_letters,
  len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_same_next FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, BITS AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bits & MASK = 0 AS kept, CAST(bits AS BIGINT) AS bits FROM b"""

_DEDUP_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g"""

#: The cheapest repair from every state, as (cost, edits, text), carried from the last row to the first.
_REPAIR_SQL = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS place,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT for z in range(8)]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS how FROM c),
d AS (SELECT conv_id, turn, place, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
  CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS again FROM h WHERE how <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, place, again) AS i FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again_said, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN again_said THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM r),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
v AS (SELECT conv_id, n AS i, {'c': 0::BIGINT, 'a': '', 't': ''} AS s0, {'c': 4::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1,
    {'c': 2::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:'} AS s2, {'c': 0::BIGINT, 'a': '', 't': ''} AS s3 FROM n
  UNION ALL SELECT conv_id, i - 1,
    list_min([w0, {'c': 2 + e2.c, 'a': 'I' || e2.a, 't': chr(10) || 'user:' || e2.t}]), list_min([w1, {'c': 2 + e2.c, 'a': 'I' || e2.a, 't': chr(10) || 'user:' || e2.t}]), e2, e3 FROM (
    SELECT *, list_min([w2, {'c': 2 + w3.c, 'a': 'I' || w3.a, 't': chr(10) || 'assistant:' || w3.t}]) AS e2, list_min([w3, {'c': 2 + w2.c, 'a': 'I' || w2.a, 't': chr(10) || 'user:' || w2.t}]) AS e3 FROM (
      SELECT v.conv_id, v.i, STEPS
      FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i)))
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM ids.conv_id AND v.i = 0"""


def _repair_steps() -> str:
    """Least (cost, edits, text) of a row's edits in each state: delete, rerole, keep."""
    out = []
    for state in range(conversations.STATES):
        role, to = conversations.ROLES[conversations.WANTS[state]], conversations.NEXT[state]
        more = "CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END"
        deleted = f"{{'c': 3 + s{state}.c, 'a': 'D' || s{state}.a, 't': s{state}.t}}"
        put = f"{{'c': 2 + {more} + s{to}.c, 'a': 'R' || s{to}.a, 't': chr(10) || '{role}:' || text || s{to}.t}}"
        keep = lambda then: f"{{'c': {more} + s{then}.c, 'a': 'K' || s{then}.a, 't': chr(10) || role || ':' || text || s{then}.t}}"
        kept = f"WHEN left(role, 1) = '{role[0]}' THEN {keep(to)}" + (f" WHEN left(role, 1) = 's' THEN {keep(1)}" if state == 0 else "")
        out.append(f"CASE WHEN fault IN ('blank', 'duplicate') THEN {deleted} ELSE list_min([{deleted}, {put}, CASE {kept} ELSE {put} END]) END AS w{state}")
    return ", ".join(out)


#: The other queries hold sampling, trees, fuzzy matches, floods or packing; their tests have brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": _JACCARD_SQL,
    "op12_exact_dedup": _DEDUP_SQL,
    "op13_conversation_repair": _REPAIR_SQL.replace("STEPS", _repair_steps()),
    "op5_rule_bitmask_ledger": _LEDGER_SQL.replace("BITS", " + ".join(f"CASE WHEN {failure} THEN {1 << k} ELSE 0 END" for k, (_, failure) in enumerate(ledger.RULES))).replace("MASK", str(ledger.mask("v1"))),
}
