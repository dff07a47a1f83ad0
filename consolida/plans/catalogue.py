"""Registered queries: every operator applied to a whole driver table, and the same in SQL.

The tables hold no decrees, so inputs are derived from their keys by integer
arithmetic, in the same way on both sides.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from consolida.functions import identifiers as ids
from consolida.functions import texts
from consolida.operators import chunking, detection, evaluation, relations, replay, tagging, trees, validation
from consolida.plans import pipeline
from consolida.plans.storage import removed, shared_folder, stored
from consolida.sources import sinks, site_files
from consolida.sources.model_calls import CallSettings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLE_SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_of(key: Column, values: list[str | None]) -> Column:
    """The value at position ``key`` modulo their number."""
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in values) + "]"


# Scores ----------------------------------------------------------------------------------------

_SCORES = """
, met AS (SELECT k, {keys}, sum(d) AS d, sum(g) AS g FROM (
    SELECT k, {keys}, 1 AS d, 0 AS g FROM detected UNION ALL SELECT k, {keys}, 0, 1 FROM truth) GROUP BY k, {keys}),
sums AS (SELECT CASE WHEN grouping(k) = 1 THEN 'TOTAL' ELSE k END AS {by}, sum(least(d, g)) AS tp, sum(d) AS nd, sum(g) AS ng FROM met GROUP BY GROUPING SETS ((k), ())),
ratios AS (SELECT *, CASE WHEN nd = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / nd END AS p, CASE WHEN ng = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / ng END AS r FROM sums)
SELECT {by}, CAST(tp AS BIGINT) AS tp, CAST(nd - tp AS BIGINT) AS fp, CAST(ng - tp AS BIGINT) AS fn, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM ratios
"""


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@registered(
    "WITH detected AS (SELECT lang AS k, doc_id, CASE WHEN n_chars > 300 THEN 1 ELSE 0 END AS q FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), truth AS (SELECT lang AS k, l.doc_id, quality AS q FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"
    + _SCORES.format(keys="doc_id, q", by="lang")
)
def q_eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of quality by length, held against the labels, per language and in all."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf_dir, "labels")
    detected = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("lang", "doc_id", F.when(F.col("n_chars") > 300, 1).otherwise(0).alias("q"))
    truth = labels.join(docs, "doc_id").select("lang", "doc_id", F.col("quality").alias("q"))
    return _rounded(evaluation.scores(detected, truth, "lang", ["doc_id", "q"]))


@registered("WITH detected AS (SELECT l_linestatus AS k, l_orderkey AS ok FROM lineitem), truth AS (SELECT o_orderstatus AS k, o_orderkey AS ok FROM orders)" + _SCORES.format(keys="ok", by="status"))
def q_multiset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys of lines against those of orders as multisets per status."""
    detected = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("status"), F.col("l_orderkey").alias("ok"))
    truth = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("ok"))
    return _rounded(evaluation.scores(detected, truth, "status", ["ok"]))


@registered("""
WITH a AS (SELECT l_suppkey % 100 AS k, l_linenumber AS n FROM lineitem), b AS (SELECT o_custkey % 100 AS k, 1 + o_orderkey % 7 AS n FROM orders)
SELECT 'both' AS part, count(*) AS n_rows FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b)
UNION ALL SELECT 'left', count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'right', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def q_multiset_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset intersection and differences, from counts of equal rows."""
    a = table(spark, sf_dir, "lineitem").select(F.expr("l_suppkey % 100 AS k"), F.expr("cast(l_linenumber AS bigint) AS n"))
    b = table(spark, sf_dir, "orders").select(F.expr("o_custkey % 100 AS k"), F.expr("1 + o_orderkey % 7 AS n"))
    counted = a.groupBy("k", "n").agg(F.count("*").alias("x")).withColumn("y", F.lit(0)).unionByName(b.groupBy("k", "n").agg(F.count("*").alias("y")).withColumn("x", F.lit(0)))
    met = counted.groupBy("k", "n").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    sums = met.agg(F.sum(F.least("x", "y")).alias("both"), F.sum(F.greatest(F.col("x") - F.col("y"), F.lit(0))).alias("left"), F.sum(F.greatest(F.col("y") - F.col("x"), F.lit(0))).alias("right"))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(c).alias("part"), F.coalesce(c, F.lit(0)).alias("n_rows")) for c in ("both", "left", "right")))))


@registered("""
WITH r AS (SELECT * FROM (VALUES ('RAIL', 1.5, 6.0), ('AIR', 0.5, 2.0)) t(model, ci, co)),
u AS (SELECT l_returnflag AS flag, CASE l_linenumber % 3 WHEN 0 THEN 'RAIL' WHEN 1 THEN 'AIR' ELSE 'OTHER' END AS model, CAST(l_quantity AS BIGINT) AS ti, l_linenumber * 10 AS tox FROM lineitem)
SELECT CASE WHEN grouping(flag) = 1 THEN 'TOTAL' ELSE flag END AS flag, CAST(sum(ti) AS BIGINT) AS tokens_in, CAST(sum(tox) AS BIGINT) AS tokens_out,
       round(sum((ti * coalesce(ci, 0.0) + tox * coalesce(co, 0.0)) / 1e6), 7) AS cost
FROM u LEFT JOIN r USING (model) GROUP BY GROUPING SETS ((flag), ())""")
def q_cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and costs per flag and in all; a model without a rate costs nothing."""
    n = F.col("l_linenumber") % 3
    usage = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.when(n == 0, "RAIL").when(n == 1, "AIR").otherwise("OTHER").alias("model"), F.col("l_quantity").cast("long").alias("tokens_in"), (F.col("l_linenumber") * 10).cast("long").alias("tokens_out"))
    rates = spark.createDataFrame([("RAIL", 1.5, 6.0), ("AIR", 0.5, 2.0)], "model string, cost_in double, cost_out double")
    return evaluation.costs(usage, rates, "flag").select("flag", "tokens_in", "tokens_out", F.round("cost", 7).alias("cost"))


# Duplicates, filters, order ----------------------------------------------------------------------


@registered("""
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY CAST(substr(o_orderpriority, 1, 1) AS INT), o_orderkey) AS n FROM orders) WHERE n = 1""")
def q_dedup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and month the order of the best priority, then of the smallest key."""
    rows = table(spark, sf_dir, "orders").withColumn("m", F.date_trunc("month", "o_orderdate"))
    best = relations.first_by(rows, ["o_custkey", "m"], F.substring("o_orderpriority", 1, 1).try_cast("int"), "o_orderkey")
    return best.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")


@registered("SELECT md5(text) AS checksum, min(doc_id) AS doc_id, count(*) AS n_docs FROM documents GROUP BY 1")
def q_exact_dup_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of equal checksum under the first of them."""
    rows = table(spark, sf_dir, "documents").select("doc_id", texts.checksum(F.col("text")).alias("checksum"))
    return rows.groupBy("checksum").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs"))


@registered("""
SELECT page_id, length(h) AS n_chars, md5(h) AS checksum FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g'), '>\\s+<', '><', 'g'), '\\s{2,}', ' ', 'g') AS h FROM pages)""")
def q_minify_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without scripts, styles and idle blanks, and their checksums."""
    rows = table(spark, sf_dir, "pages").select("page_id", texts.minify(F.col("html")).alias("h"))
    return rows.select("page_id", F.length("h").cast("long").alias("n_chars"), texts.checksum(F.col("h")).alias("checksum"))


@registered("""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)(<script\\b[^>]*>).*?</script', '\\1</script', 'g'), '(?is)(<style\\b[^>]*>).*?</style', '\\1</style', 'g'), '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages)
SELECT page_id, lower(tag) AS tag, count(*) AS n_nodes FROM t GROUP BY 1, 2""")
def q_page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of every page by tag, from the node table."""
    return trees.nodes(table(spark, sf_dir, "pages"), "page_id").groupBy("page_id", "tag").agg(F.count("*").alias("n_nodes"))


@registered("""
WITH ops AS (SELECT l_orderkey AS source, l_partkey % 3 AS target, l_orderkey * 10 + l_linenumber AS seq, l_returnflag AS t,
    CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 'FULL_SECTION' ELSE 'ALINEA' END AS st, l_linenumber % 2 AS pos FROM lineitem),
p AS (SELECT *, coalesce(st, 'FULL_SECTION') = 'FULL_SECTION' AS f FROM ops),
w AS (SELECT *, max(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY source, target) AS precise,
    row_number() OVER (PARTITION BY source, target, f, CASE WHEN f THEN NULL ELSE st END, CASE WHEN f THEN NULL ELSE pos END, t ORDER BY seq) AS n FROM p)
SELECT source, target, t AS operation_type, count(*) AS n_ops, CAST(sum(seq) AS BIGINT) AS seqs FROM w WHERE n = 1 AND NOT (f AND precise = 1) GROUP BY 1, 2, 3""")
def q_redundancy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most precise operations of each source and target."""
    n = F.col("l_linenumber") % 3
    ops = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("source"), (F.col("l_partkey") % 3).alias("target"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_returnflag").alias("operation_type"),
        F.when(n == 1, "FULL_SECTION").when(n == 2, "ALINEA").alias("sub_type"), (F.col("l_linenumber") % 2).alias("sub_position"),
    )
    kept = relations.without_redundant(ops, ("source", "target"))
    return kept.groupBy("source", "target", "operation_type").agg(F.count("*").alias("n_ops"), F.sum("seq").alias("seqs"))


_OPS_SQL = """
ops AS (SELECT l_suppkey % 10 AS aiot, l_orderkey * 10 + l_linenumber AS seq, CAST(l_orderkey % 25 AS VARCHAR) AS sd, CAST(l_partkey % 30 AS VARCHAR) AS td,
  CASE WHEN l_linenumber = 1 THEN 'ALL' ELSE CAST(l_linenumber AS VARCHAR) END AS ta, CASE l_returnflag WHEN 'R' THEN 'REMOVE' WHEN 'A' THEN 'ADD' ELSE 'REPLACE' END AS t,
  CASE WHEN l_quantity < 25 THEN NULL WHEN l_quantity < 40 THEN 'FULL_SECTION' ELSE 'ALINEA' END AS st, l_tax = 0 AS skip FROM lineitem),
decrees AS (SELECT s_suppkey % 10 AS aiot, CAST(s_nationkey AS VARCHAR) AS td, bool_or(s_acctbal > 9000) AS principal FROM supplier GROUP BY 1, 2)"""


def _ops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    flag, q = F.col("l_returnflag"), F.col("l_quantity")
    ops = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("aiot"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.lit("1").alias("source_article"),
        (F.col("l_orderkey") % 25).cast("string").alias("source_decree"), (F.col("l_partkey") % 30).cast("string").alias("target_decree"),
        F.when(F.col("l_linenumber") == 1, "ALL").otherwise(F.col("l_linenumber").cast("string")).alias("target_article"), F.when(flag == "R", "REMOVE").when(flag == "A", "ADD").otherwise("REPLACE").alias("operation_type"),
        F.when(q < 25, None).when(q < 40, "FULL_SECTION").otherwise("ALINEA").alias("sub_type"), F.lit(None).cast("int").alias("sub_position"),
        F.when(F.col("l_tax") == 0, F.array(F.lit("not_an_operation"))).otherwise(F.expr("cast(array() as array<string>)")).alias("error_codes"),
    )
    decrees = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 10).alias("aiot"), F.col("s_nationkey").cast("string").alias("decree_id")).agg(F.bool_or(F.col("s_acctbal") > 9000).alias("principal"))
    return ops, decrees


@registered(f"""
WITH {_OPS_SQL},
j AS (SELECT o.*, d.td IS NOT NULL AS there, coalesce(d.principal, false) AS principal, ta = 'ALL' AND t IN ('REMOVE', 'REPLACE') AND coalesce(st, 'FULL_SECTION') = 'FULL_SECTION' AND NOT skip AS removal
      FROM ops o LEFT JOIN decrees d ON d.aiot = o.aiot AND d.td = o.td),
w AS (SELECT *, max(CASE WHEN removal THEN 0 ELSE 1 END) OVER (PARTITION BY aiot, sd, td) AS others FROM j),
c AS (SELECT *, CASE WHEN skip THEN 'not_an_operation' WHEN removal AND principal THEN 'error_extracting_target' WHEN removal AND others = 1 THEN 'less_important' WHEN NOT there THEN 'missing_arrete' ELSE '' END AS code FROM w)
SELECT aiot, code, operation_type, count(*) AS n_ops, CAST(sum(CASE WHEN removal AND code = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_abrogates FROM (SELECT *, t AS operation_type FROM c) GROUP BY 1, 2, 3""")
def q_classify_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations by the first conflict each of them has."""
    done = relations.classify(*_ops(spark, sf_dir)).withColumn("code", F.array_join("error_codes", ","))
    return done.groupBy("aiot", "code", "operation_type").agg(F.count("*").alias("n_ops"), F.sum(F.col("abrogates").cast("long")).alias("n_abrogates"))


@registered(f"""
WITH {_OPS_SQL}
SELECT aiot, count(*) AS n_ops, CAST(sum(CASE WHEN skip OR (t IN ('REMOVE', 'REPLACE') AND coalesce(st, '') = 'FULL_SECTION') THEN 1 ELSE 0 END) AS BIGINT) AS n_unambiguous,
  CAST(sum(CASE WHEN skip THEN 1 ELSE 0 END) AS BIGINT) AS n_low, CAST(sum(CASE WHEN skip THEN 0 ELSE 1 END) AS BIGINT) AS n_resolved,
  CAST(sum(CASE WHEN (ta <> 'ALL' OR t = 'REMOVE') AND (t = 'REMOVE' OR seq % 4 <> 0) THEN 1 ELSE 0 END) AS BIGINT) AS n_reliable,
  CAST(sum(CASE WHEN ta = 'ALL' AND coalesce(st, 'FULL_SECTION') <> 'FULL_SECTION' THEN 1 ELSE 0 END) AS BIGINT) AS n_derived
FROM ops GROUP BY 1""")
def q_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates on operations, counted."""
    ops = _ops(spark, sf_dir)[0].withColumn("operand", F.when(F.col("seq") % 4 != 0, F.lit("<p/>")))
    codes = validation.derived_codes(F.lit(None), F.col("operation_type"), F.col("target_article"), F.col("sub_type"))
    flags = {"n_unambiguous": validation.is_unambiguous(), "n_low": texts.low_severity(F.col("error_codes")), "n_resolved": validation.is_resolved(), "n_reliable": validation.characterised(), "n_derived": F.array_contains(codes, "error_extracting_operand")}
    return ops.groupBy("aiot").agg(F.count("*").alias("n_ops"), *(F.count_if(c).alias(n) for n, c in flags.items()))


@registered("""
WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(round(l_discount * 1000) AS INT) END AS score FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, score, had_low FROM (SELECT *, coalesce(bool_or(score < 50) OVER (PARTITION BY l_orderkey), false) AS had_low FROM s) WHERE score IS NULL OR score >= 50""")
def q_confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores below the threshold go, unknown ones stay; whether an order had a low one."""
    score = F.when(F.col("l_linenumber") != 7, F.round(F.col("l_discount") * 1000).cast("int"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), score.alias("confidence_score"))
    return validation.by_confidence(rows, 50, "l_orderkey").withColumnRenamed("confidence_score", "score")


@registered("""
SELECT o_custkey AS aiot, o_orderkey AS decree_id, role FROM (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber >= 5) THEN 'modifying' ELSE 'complement' END AS role
  FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 10 <> 0)""")
def q_other_decrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active decrees beside the principal one, by whether an operation starts from them."""
    decrees = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("aiot"), F.col("o_orderkey").alias("decree_id"), (F.col("o_orderstatus") != "F").alias("active"), (F.col("o_orderkey") % 10 == 0).alias("principal"))
    ops = table(spark, sf_dir, "lineitem").where("l_linenumber >= 5").select(F.col("l_orderkey").alias("source_decree")).join(decrees.select("aiot", F.col("decree_id").alias("source_decree")), "source_decree")
    return relations.other_decrees(decrees, ops).select("aiot", "decree_id", "role")


@registered("""
WITH d AS (SELECT o_custkey AS aiot, strftime(o_orderdate, '%Y-%m-%d') || '#' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS decree_id, o_orderstatus <> 'F' AS active, o_orderpriority = '1-URGENT' AS auth, o_orderkey % 97 = 0 AS flagged FROM orders),
r AS (SELECT *, CASE WHEN flagged THEN 0 WHEN active AND auth THEN 1 WHEN active THEN 2 ELSE 3 END AS k, row_number() OVER (PARTITION BY aiot ORDER BY decree_id) AS place, sum(CASE WHEN flagged THEN 1 ELSE 0 END) OVER (PARTITION BY aiot) AS n_flagged FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY aiot ORDER BY k, CASE WHEN k = 1 THEN -place ELSE place END) AS n FROM r)
SELECT aiot, decree_id, n_flagged > 1 AS several FROM n WHERE n = 1""")
def q_principal_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The principal decree of each site."""
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("#"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("aiot"), name.alias("decree_id"), (F.col("o_orderstatus") != "F").alias("active"), F.when(F.col("o_orderpriority") == "1-URGENT", "AP_AUTORISATION").otherwise("AUTRE").alias("file_type"), (F.col("o_orderkey") % 97 == 0).alias("principal"))
    return relations.principal(rows).select("aiot", "decree_id", F.col("error").isNotNull().alias("several"))


@registered("""
WITH d AS (SELECT o_custkey AS aiot, strftime(o_orderdate, '%Y-%m-%d') AS decree_id, o_orderkey FROM orders)
SELECT aiot, decree_id, o_orderkey FROM (SELECT *, min(decree_id) OVER (PARTITION BY aiot) AS s FROM d) WHERE decree_id > s""")
def q_start_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decrees after the first date of their site."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("aiot"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("decree_id"), "o_orderkey")
    return relations.start_filter(rows)


_TITLES = ["Exécution", "FRAIS  ", "Délais et voies de recours", "Prescriptions", "échéances", "Article 1", None, "Publicité"]


@registered(f"""
WITH t AS (SELECT doc_id, {sql_list(_TITLES)}[1 + doc_id % {len(_TITLES)}] AS title FROM documents)
SELECT doc_id, title FROM t WHERE title IS NULL OR lower(strip_accents(trim(title))) NOT IN ('execution', 'frais', 'delais et voies de recours', 'echeances', 'publicite')""")
def q_superfluous_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections whose title a consolidated permit keeps."""
    rows = table(spark, sf_dir, "documents").select("doc_id", case_of(F.col("doc_id"), _TITLES).alias("title"))
    return rows.where(~texts.superfluous(F.col("title")))


# Versions ----------------------------------------------------------------------------------------


@registered("""
SELECT user_id, count(*) AS n_versions, arg_max(event_id, v) AS last_op, arg_max(event_type, v) AS last_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v FROM events) GROUP BY 1""")
def q_version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of each target and the latest of them."""
    rows = replay.version_numbers(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")
    return replay.latest(rows, ["user_id"], "event_id", "event_type").select("user_id", F.col("version").cast("long").alias("n_versions"), F.col("event_id").alias("last_op"), F.col("event_type").alias("last_type"))


@registered("""
WITH e AS (SELECT *, event_type = 'error' AS bad, event_type = 'signup' AS clears, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
i AS (SELECT *, sum(CASE WHEN clears THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS island FROM e)
SELECT event_id, coalesce(bool_or(bad) OVER (PARTITION BY user_id, island ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AND NOT clears AS propagated FROM i""")
def q_error_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations that an earlier error blocks."""
    rows = table(spark, sf_dir, "events").withColumn("bad", F.col("event_type") == "error").withColumn("clears", F.col("event_type") == "signup")
    return replay.propagated(rows, ["user_id"], ["ts", "event_id"], "bad", "clears").select("event_id", "propagated")


@registered("""
WITH RECURSIVE e AS (SELECT event_id, user_id, event_type = 'error' AS own, event_type = 'signup' AS clears, event_id % 3 = 0 AS exempt, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT event_id, user_id, n, false AS blocked, own AS bad, CASE WHEN own THEN exempt ELSE true END AS only_exempt FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, f.bad AND NOT f.only_exempt AND NOT e.clears, e.own OR (f.bad AND NOT f.only_exempt AND NOT e.clears),
    CASE WHEN NOT (e.own OR (f.bad AND NOT f.only_exempt AND NOT e.clears)) THEN true ELSE (CASE WHEN f.bad THEN f.only_exempt ELSE true END) AND e.exempt END
  FROM f JOIN e ON e.user_id = f.user_id AND e.n = f.n + 1)
SELECT event_id, blocked FROM f""")
def q_propagation_exempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where trailing errors of abrogated decrees do not block."""
    kind = F.col("event_type")
    steps = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (kind == "error").alias("error"), (kind == "signup").alias("clears"), (F.col("event_id") % 3 == 0).alias("exempt"))
    return replay.blocked(steps, "user_id", ["ts", "event_id"], "error", "clears", "exempt").select("event_id", "blocked")


@registered("""
WITH s AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
t AS (SELECT s.conv_id, s.turn, s.size, s.n FROM s)
SELECT conv_id, turn, chunk FROM (
  WITH RECURSIVE f AS (SELECT conv_id, turn, n, 0 AS chunk, CASE WHEN size >= 300 THEN 0 ELSE size END AS at, CASE WHEN size >= 300 THEN 1 ELSE 0 END AS nxt FROM t WHERE n = 1
    UNION ALL SELECT t.conv_id, t.turn, t.n, f.nxt, CASE WHEN f.at + t.size >= 300 THEN 0 ELSE f.at + t.size END, f.nxt + CASE WHEN f.at + t.size >= 300 THEN 1 ELSE 0 END
    FROM f JOIN t ON t.conv_id = f.conv_id AND t.n = f.n + 1) SELECT * FROM f)""")
def q_chunk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns packed into chunks of about 300 characters; a chunk ends with the turn that fills it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return chunking.chunked(rows, "conv_id", "turn", "size", 300)


# Identifiers and texts ---------------------------------------------------------------------------


@registered("""
WITH i AS (SELECT DISTINCT p_size % 12 AS a, p_partkey % 15 AS b FROM part)
SELECT CAST(a AS VARCHAR) || '.' || CAST(b AS VARCHAR) AS article_id, row_number() OVER (ORDER BY a, b) AS by_number, row_number() OVER (ORDER BY CAST(a AS VARCHAR) || '.' || CAST(b AS VARCHAR)) AS by_text FROM i""")
def q_article_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in order of their numbers and in order of their text."""
    name = F.concat_ws(".", (F.col("p_size") % 12).cast("string"), (F.col("p_partkey") % 15).cast("string"))
    rows = table(spark, sf_dir, "part").select(name.alias("article_id")).distinct().withColumn("key", ids.sort_key(F.col("article_id")))
    return rows.select("article_id", F.expr("cast(row_number() OVER (ORDER BY key) AS bigint) AS by_number"), F.expr("cast(row_number() OVER (ORDER BY article_id) AS bigint) AS by_text"))


@registered("""
WITH p AS (SELECT p_brand, p_size, p_partkey, p_partkey % 7 = 0 AS fresh FROM part)
SELECT n.p_brand, CAST(n.p_size AS VARCHAR) || '.' || CAST(n.p_partkey AS VARCHAR) AS number, (SELECT arg_max(CAST(o.p_size AS VARCHAR) || '.' || CAST(o.p_partkey AS VARCHAR), CAST(o.p_size AS BIGINT) * 1000000000 + o.p_partkey)
  FROM p o WHERE o.p_brand = n.p_brand AND NOT o.fresh AND (o.p_size < n.p_size OR o.p_size = n.p_size AND o.p_partkey < n.p_partkey)) AS predecessor FROM p n WHERE n.fresh""")
def q_asof_predecessor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New articles with the greatest existing number before theirs."""
    rows = table(spark, sf_dir, "part").select("p_brand", F.concat_ws(".", F.col("p_size").cast("string"), F.col("p_partkey").cast("string")).alias("number"), (F.col("p_partkey") % 7 == 0).alias("fresh"))
    return relations.predecessor(rows, ["p_brand"], "number", "fresh").select("p_brand", "number", "predecessor")


@registered("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, '2.' || CAST(i AS VARCHAR) AS article, CASE WHEN i = l_linenumber THEN 'REPLACE' ELSE 'REMOVE' END AS operation_type
FROM (SELECT l_orderkey, l_linenumber, unnest(range(l_linenumber, l_linenumber + 1 + l_partkey % 4)) AS i FROM lineitem)""")
def q_range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of articles spelled out; the first is replaced, the others are removed."""
    start, end = F.concat(F.lit("2."), F.col("l_linenumber").cast("string")), F.concat(F.lit("2."), (F.col("l_linenumber") + F.col("l_partkey") % 4).cast("string"))
    rows = table(spark, sf_dir, "lineitem").withColumn("articles", ids.article_range(start, end)).withColumn("operation_type", F.lit("REPLACE"))
    rows = rows.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "operation_type", F.posexplode("articles").alias("nth", "article"))
    return rows.select("l_orderkey", "l_linenumber", "article", relations.range_roles(F.col("operation_type"), F.col("nth")).alias("operation_type"))


#: (input, canonical form, valid as it is, levels) of article ids.
_ARTICLES = [
    ("1.2", "1.2", True, "1.2"), (" 1 . 2 ", "1.2", False, ""), ("all", "ALL", False, ""), ("ALL", "ALL", True, "999999"), ("appendix", "APPENDIX", False, ""), ("Appendix: 3 . 1", "APPENDIX:3.1", False, ""),
    ("APPENDIX:3", "APPENDIX:3", True, "3"), ("new_article:4-1", "NEW_ARTICLE:4-1", False, ""), ("NEW_ARTICLE:2.9", "NEW_ARTICLE:2.9", True, "2.9"), ("the third one", None, False, ""), ("", None, False, ""), (None, None, False, ""),
    ("IV", "IV", True, "4"), ("2.IX", "2.IX", True, "2.9"), ("H", "H", True, "8"), ("3.B", "3.B", True, "3.2"), ("ZZZ", None, False, ""), ("I.1", "I.1", True, "1.1"), ("C", "C", True, "3"), ("a", "a", True, "1"),
]


@registered(f"""
SELECT p_partkey, l[k] AS article, c[k] AS canonical, v[k] = 'true' AS valid, CASE WHEN v[k] = 'true' THEN s[k] ELSE '' END AS levels FROM (SELECT p_partkey, 1 + p_partkey % {len(_ARTICLES)} AS k,
 {sql_list([a[0] for a in _ARTICLES])} AS l, {sql_list([a[1] for a in _ARTICLES])} AS c, {sql_list([str(a[2]).lower() for a in _ARTICLES])} AS v, {sql_list([a[3] for a in _ARTICLES])} AS s FROM part)""")
def q_article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article ids: canonical form, validity, levels."""
    rows = table(spark, sf_dir, "part").select("p_partkey", case_of(F.col("p_partkey"), [a[0] for a in _ARTICLES]).alias("article"))
    valid = ids.valid_article(F.col("article"))
    return rows.select("p_partkey", "article", ids.canonical_article(F.col("article")).alias("canonical"), valid.alias("valid"), F.when(valid, F.array_join(ids.sort_key(F.col("article")), ".")).otherwise("").alias("levels"))


#: (file name, decree, kind or reason).
_FILES = [
    ("2020-01-31.html", "2020-01-31", "AUTRE"), ("2021-02-31_AP d'autorisation_x.html", "2021-02-31", "AP_AUTORISATION"), ("2021-1-5_arrêté préfectoral.html", "2021-1-5", "ARRETE_PREFECTORAL"),
    ("2019-07-01_ap prescriptions complémentaires_b.html", "2019-07-01", "AP_COMPLEMENTAIRE"), ("2019-13-01_x.html", None, "date"), ("note.pdf", None, "extension"), ("1899-01-01.html", None, "date"), ("2018-05-05_lettre.html", "2018-05-05", "AUTRE"),
]


@registered(f"""
SELECT o_orderkey, f[k] AS filename, d[k] AS decree_id, t[k] AS outcome FROM (SELECT o_orderkey, 1 + o_orderkey % {len(_FILES)} AS k, {sql_list([a[0] for a in _FILES])} AS f, {sql_list([a[1] for a in _FILES])} AS d, {sql_list([a[2] for a in _FILES])} AS t FROM orders)""")
def q_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decree and kind of file names, or why there is none."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", case_of(F.col("o_orderkey"), [a[0] for a in _FILES]).alias("filename")).withColumn("n", ids.parse_filename(F.col("filename")))
    return rows.select("o_orderkey", "filename", F.col("n.decree_id").alias("decree_id"), F.coalesce("n.reason", "n.file_type").alias("outcome"))


#: (phrase, type, position).
_PHRASES = [
    ("le premier alinea", "ALINEA", 1), ("ALL", "FULL_SECTION", None), (None, "FULL_SECTION", None), ("  ", "FULL_SECTION", None), ("la 2eme phrase", "PHRASE", 2), ("la troisieme ligne du tableau", "LIGNE_TABLEAU", 3),
    ("le premier alinea apres le tableau", "TABLEAU", None), ("dernier alinea", "ALINEA", -1), ("quatrieme colonne", "COLONNE_TABLEAU", 4), ("le mot pollution", "COMPLEX", None), ("Contenu entier", "FULL_SECTION", None), ("dixieme ligne tableau", "LIGNE_TABLEAU", 10),
]


@registered(f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, t[k] AS sub_type, CAST(p[k] AS BIGINT) AS sub_position FROM (SELECT l_orderkey, l_linenumber, 1 + l_partkey % {len(_PHRASES)} AS k, {sql_list([a[1] for a in _PHRASES])} AS t, {sql_list([a[2] for a in _PHRASES])} AS p FROM lineitem)""")
def q_subtarget_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and position of sub-target phrases."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), case_of(F.col("l_partkey"), [a[0] for a in _PHRASES]).alias("phrase"))
    return validation.with_subtarget(rows, "phrase", "s").select("l_orderkey", "l_linenumber", F.col("s.type").alias("sub_type"), F.col("s.position").cast("long").alias("sub_position"))


_CODES = ["error_finding_subtarget", "less_important", "missing_arrete", "disabled_llm_call", "unknown_code"]


@registered(f"""
WITH c AS (SELECT DISTINCT user_id, {sql_list(_CODES)}[1 + event_id % {len(_CODES)}] AS code FROM events WHERE event_type = 'error'),
m AS (SELECT user_id, code, CASE code {" ".join(f"WHEN '{c}' THEN '" + texts.MESSAGES.get(c, texts.DEFAULT_MESSAGE).replace("'", "''") + "'" for c in _CODES)} END AS text FROM c)
SELECT user_id, string_agg(text, ' ; ' ORDER BY code) AS reason, bool_and(code IN ('less_important', 'missing_arrete')) AS low FROM m GROUP BY 1""")
def q_error_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of each target's error codes."""
    rows = table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", case_of(F.col("event_id"), _CODES).alias("code"))
    sets = rows.groupBy("user_id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return sets.select("user_id", texts.error_reason(F.col("codes")).alias("reason"), texts.low_severity(F.col("codes")).alias("low"))


@registered("""
SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_items, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS first_k FROM events""")
def q_json_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays inside replies with text around them; a reply without one gives an empty list."""
    reply = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("none: "), "props")).otherwise(F.concat(F.lit("Here:\n["), "props", F.lit(', {"k": 1}] done')))
    items = texts.json_list(reply, "struct<k:bigint>")
    return table(spark, sf_dir, "events").select("event_id", F.size(items).cast("long").alias("n_items"), F.get(items, F.lit(0))["k"].alias("first_k"))


@registered("""
SELECT doc_id, CAST(2 AS BIGINT) AS n_images, 'x<img src="u' || CAST(doc_id AS VARCHAR) || '"/>y<img src="v"/>z' AS back FROM documents""")
def q_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images taken out of a text and put back."""
    html = F.concat(F.lit('x<img alt="a" src="u'), F.col("doc_id").cast("string"), F.lit('">y<img data-src="v"/>z'))
    rows = table(spark, sf_dir, "documents").select("doc_id", texts.images_out(html).alias("o"))
    return rows.select("doc_id", F.size("o.images").cast("long").alias("n_images"), texts.images_in(F.col("o.html"), F.col("o.images")).alias("back"))


@registered("""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, substr(coalesce(text, ''), 1 + length(coalesce(text, '')) // 2, 12) AS m FROM documents)
SELECT doc_id, CAST(CASE WHEN regexp_matches(m, '[^\x20\x09-\x0D]') THEN instr(text, m) - 1 END AS BIGINT) AS start_at, CAST(CASE WHEN regexp_matches(m, '[^\x20\x09-\x0D]') THEN instr(text, m) - 1 + length(m) END AS BIGINT) AS end_at FROM t""")
def q_marker_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a marker taken from the middle of a text stands in it first; no place for one without a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), F.substring(text, F.floor(F.length(text) / 2).cast("int") + 1, F.lit(12)).alias("m"))
    return rows.select("doc_id", texts.marker_span(F.col("text"), F.when(F.col("m").rlike(r"[^\x20\x09-\x0D]"), F.col("m"))).alias("s")).select("doc_id", F.col("s.start").cast("long").alias("start_at"), F.col("s.end").cast("long").alias("end_at"))


_RAW = {
    "source_article": ["1", None, "2.1", "free text", "3"],
    "target_article": ["1.2", "ALL", None, "4", "x y z"],
    "source_arrete": ["2020-01-01", "2020-1-1", "bad", "2020-01-01", "2021-02-31"],
    "operation_type": ["add", "REPLACE", "delete", "autre", "replace"],
}


@registered(f"""
WITH r AS (SELECT o_orderkey, {", ".join(f"{sql_list(v)}[1 + (o_orderkey // {5**i}) % 5] AS {k}" for i, (k, v) in enumerate(_RAW.items()))} FROM orders),
c AS (SELECT *, CASE WHEN source_article IS NULL THEN 'source_article' WHEN target_article IS NULL THEN 'target_article' WHEN source_arrete = 'bad' THEN 'source_arrete'
  WHEN source_article = 'free text' THEN 'source_article_id' WHEN target_article = 'x y z' THEN 'target_article_id' WHEN operation_type = 'autre' THEN 'autre' ELSE 'kept' END AS reason,
  CASE WHEN target_article = 'ALL' AND lower(operation_type) = 'replace' THEN 'REMOVE' ELSE CASE operation_type WHEN 'add' THEN 'ADD' WHEN 'delete' THEN 'REMOVE' ELSE 'REPLACE' END END AS kind FROM r),
k AS (SELECT reason, CASE WHEN reason = 'kept' THEN source_arrete || '#' || source_article || ' ' || target_article || ' ' || kind || ' ' || CASE WHEN o_orderkey % 2 = 0 THEN 'ALINEA 1 premier alinéa' ELSE 'FULL_SECTION - ALL' END || ' '
  || CASE WHEN target_article = 'ALL' AND lower(operation_type) = 'replace' THEN '-' ELSE 'text' END || ' '
  || CASE WHEN target_article = 'ALL' AND o_orderkey % 2 = 0 THEN 'error_extracting_operand' WHEN target_article = 'ALL' AND kind = 'ADD' THEN 'not_an_operation' ELSE '' END ELSE '' END AS converted FROM c)
SELECT reason, converted, count(*) AS n_ops FROM k GROUP BY 1, 2""")
def q_raw_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw operations by the first check they fail, or by what they are converted to."""
    cases = [case_of(F.floor(F.col("o_orderkey") / F.lit(5**i)), v).alias(k) for i, (k, v) in enumerate(_RAW.items())]
    sub = F.when(F.col("o_orderkey") % 2 == 0, "premier alinéa").alias("sub_target")
    raw = table(spark, sf_dir, "orders").select(*cases, F.lit("2019-01-01").alias("target_arrete"), sub, F.lit("text").alias("operand"))
    done = validation.from_raw(raw)
    node = F.concat_ws("#", "source_decree", "source_article")
    position = F.coalesce(F.col("sub_position").cast("string"), F.lit("-"))
    converted = F.concat_ws(" ", node, "target_article", "operation_type", "sub_type", position, "sub_description", F.coalesce("operand", F.lit("-")), F.array_join("error_codes", ","))
    kept = F.col("reject_reason").isNull()
    return done.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason"), F.when(kept, converted).otherwise(F.lit("")).alias("converted")).agg(F.count("*").alias("n_ops"))


@registered("""
WITH RECURSIVE l AS (SELECT DISTINCT n_nationkey AS src, (n_nationkey * 7 + 3) % 25 AS dst FROM nation UNION SELECT s_nationkey, CAST(s_suppkey % 25 AS INT) FROM supplier UNION SELECT DISTINCT 100 + o_custkey, 100 + o_custkey // 2 FROM orders),
z AS (SELECT DISTINCT r_regionkey AS seed FROM region UNION SELECT DISTINCT 100 + o_custkey FROM orders),
r(seed, node, steps) AS (SELECT seed, seed, 0 FROM z UNION SELECT r.seed, l.dst, r.steps + 1 FROM r JOIN l ON l.src = r.node WHERE r.steps < 60)
SELECT CAST(seed AS BIGINT) AS seed, CAST(node AS BIGINT) AS node, CAST(min(steps) AS BIGINT) AS steps FROM r GROUP BY 1, 2""")
def q_downstream_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that changes reach, by their shortest way."""
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("src"), ((F.col("n_nationkey") * 7 + 3) % 25).cast("long").alias("dst"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("src"), (F.col("s_suppkey") % 25).alias("dst"))
    customers = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("src"), (F.floor(F.col("o_custkey") / 2) + 100).alias("dst")).distinct()
    seeds = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("node")).unionByName(customers.select(F.col("src").alias("node")))
    return relations.downstream(a.unionByName(b).unionByName(customers), seeds).withColumn("steps", F.col("steps").cast("long"))


@registered("SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 2 ORDER BY l_linenumber) - 1 AS BIGINT) AS key, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem")
def q_parallel_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel edges of the operations graph, numbered."""
    ops = table(spark, sf_dir, "lineitem").select(F.lit("a").alias("aiot"), "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.col("l_orderkey").cast("string").alias("source_decree"), F.lit("1").alias("source_article"), (F.col("l_suppkey") % 2).cast("string").alias("target_decree"), F.lit("1").alias("target_article"), F.col("l_linenumber").alias("seq"))
    return relations.nodes_and_edges(ops)[1].select("l_orderkey", F.col("key").cast("long").alias("key"), "l_linenumber")


# Whole documents ---------------------------------------------------------------------------------


def made_decrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decree per page: two articles with its whole text of its site's first decree, or a change of one of them to its whole text by a later one."""
    n = F.col("page_id")
    text = F.regexp_replace("html", "<[^>]*>", " ")
    text = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    date = F.concat(F.lit("20"), F.lpad((n % 10 + 10).cast("string"), 2, "0"), F.lit("-01-01"))
    article = lambda k: F.concat(F.lit(f'<section data-spec="section" data-type="article" data-number="{k}"><h2 data-spec="section_title">Article {k}</h2><div data-spec="alinea" data-number="1">'), text, F.lit("</div></section>"))
    first = F.concat(F.lit('<body data-arretify_version="0.2.1"><main>'), article(1), article(2), F.lit("</main></body>"))
    quoted = F.concat(F.lit("<q>"), text, F.lit("</q>"))
    verb = F.when(n % 3 == 0, F.concat(F.lit("est remplacé par les dispositions suivantes : "), quoted)).when(n % 3 == 1, F.concat(F.lit("est abrogé. "), quoted)).otherwise(F.concat(F.lit("est complété par : "), quoted))
    change = F.concat(
        F.lit('<body data-arretify_version="0.2.1"><main><section data-spec="section" data-type="article" data-number="1"><div data-spec="alinea" data-number="1">L\'<a data-spec="section_reference" data-type="article" data-tag_id="r1" data-parent_reference="d1" data-start_num="'),
        (n % 2 + 1).cast("string"),
        F.lit('">article</a> de l\'<a data-spec="document_reference" data-tag_id="d1" data-date="2010-01-01">arrêté</a> '),
        verb,
        F.lit("</div></section></main></body>"),
    )
    return table(spark, sf_dir, "pages").select(F.floor(n / 10).cast("string").alias("aiot"), date.alias("decree_id"), F.concat(date, F.lit(".html")).alias("filename"), F.when(n % 10 == 0, first).otherwise(change).alias("html"), F.lit("AUTRE").alias("file_type"), F.lit(True).alias("active"), (n % 10 == 0).alias("principal"))


#: The pages' texts, and the changes made from them.
_PAGES = """t AS (SELECT page_id, CAST(page_id // 10 AS VARCHAR) AS aiot, '20' || CAST(page_id % 10 + 10 AS VARCHAR) || '-01-01' AS d,
  replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS text FROM pages),
o AS (SELECT aiot, d, CAST(page_id % 2 + 1 AS VARCHAR) AS article, page_id % 3 AS kind, text, row_number() OVER (PARTITION BY aiot, page_id % 2 ORDER BY d) AS v,
  CASE page_id % 3 WHEN 0 THEN 'modification' WHEN 1 THEN 'abrogation' ELSE 'ajout' END AS label FROM t WHERE page_id % 10 <> 0)"""
#: Versions of the first decree's two articles.
_VERSIONS = _PAGES + """,
h AS (SELECT aiot, article, CAST(0 AS BIGINT) AS v, '<div data-spec="alinea" data-number="1">' || text || '</div>' AS content FROM t, (SELECT unnest(['1', '2']) AS article) WHERE page_id % 10 = 0
  UNION ALL SELECT h.aiot, h.article, o.v, CASE o.kind WHEN 0 THEN o.text WHEN 1 THEN '' ELSE h.content || o.text END FROM h JOIN o ON o.aiot = h.aiot AND o.article = h.article AND o.v = h.v + 1)"""


@registered(f"""
WITH {_PAGES}
SELECT aiot, d AS decree_id, '2010-01-01' AS target_decree, article AS target_article, CASE kind WHEN 0 THEN 'REPLACE' WHEN 1 THEN 'REMOVE' ELSE 'ADD' END AS operation_type, CASE WHEN kind <> 1 THEN text END AS operand FROM o""")
def q_tagged_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations that the verb grammar finds in decrees made from the pages."""
    raw = tagging.raw_operations(tagging.tag_operations(made_decrees(spark, sf_dir)))
    operand = F.when(F.col("operation_type") != "REMOVE", F.col("operand")).alias("operand")
    return raw.select("aiot", "decree_id", F.col("target_arrete").alias("target_decree"), "target_article", "operation_type", operand)


@registered(f"""
WITH RECURSIVE {_VERSIONS}
SELECT h.aiot, h.article AS article_id, h.v AS version, '<h2 data-spec="section_title">Article ' || h.article || '</h2>' AS title, content, o.d AS changed_by, '' AS codes FROM h LEFT JOIN o ON o.aiot = h.aiot AND o.article = h.article AND o.v = h.v""")
def q_replay_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the first decree's articles after the replay of all later decrees, with title, content, decree and codes."""
    decrees = made_decrees(spark, sf_dir)
    done = pipeline.consolidate(decrees, pipeline.tagged_operations(decrees), render=False)
    by = done.operations.select("aiot", F.col("id").alias("operation_id"), F.col("source_decree").alias("changed_by"))
    rows = done.versions.where("decree_id = '2010-01-01'").join(by, ["aiot", "operation_id"], "left")
    return rows.select("aiot", "article_id", F.col("version").cast("long").alias("version"), "title", "content", "changed_by", F.array_join("error_codes", ",").alias("codes"))


@registered(f"""
WITH RECURSIVE {_VERSIONS},
w AS (SELECT h.*, o.d, o.label, o.kind, max(h.v) OVER (PARTITION BY h.aiot, h.article) AS n FROM h LEFT JOIN o ON o.aiot = h.aiot AND o.article = h.article AND o.v = h.v),
l AS (SELECT *, CASE WHEN v = 0 THEN 'Version de l''arrêté initial' ELSE 'Version après ' || label || ' par l''article 1 de l''arrêté ' || d END AS then_text FROM w),
b AS (SELECT aiot, article, max(n) AS n, max(CASE WHEN v = n THEN d END) AS last, max(CASE WHEN v = n THEN CASE WHEN kind = 1 THEN '<p><em>Article abrogé</em></p>' ELSE content END END) AS body, max(CASE WHEN v = 0 THEN content END) AS original,
  '<div data-spec="section_version_history">' || max(CASE WHEN v = n THEN '<p><b>Version actuelle après ' || label || ' par l''article 1 de l''arrêté ' || d || '</b></p>' END)
    || string_agg(CASE WHEN v = n THEN '' ELSE '<details><summary>' || then_text || '</summary><div>' || content || '</div></details>' END, '' ORDER BY v) || '</div>' AS history FROM l GROUP BY 1, 2),
s AS (SELECT aiot, string_agg('<section data-spec="section_version" data-type="article" data-number="' || article || CASE WHEN n > 0 THEN '" data-is_modified="true" data-date_version="' || last ELSE '" data-is_modified="false" data-date_version="2010-01-01' END
    || '"><h2 data-spec="section_title">Article ' || article || '</h2>' || CASE WHEN n > 0 THEN history || body ELSE original END || '</section>', '' ORDER BY article) AS html FROM b GROUP BY 1),
m AS (SELECT aiot, string_agg('<article data-spec="permit_modifying" data-date="' || d || '"><main><section data-spec="section_version" data-type="article" data-number="1" data-is_modified="false" data-date_version="' || d
    || '"><div data-spec="operation_result">Opération de consolidation résolue (' || label || ') dans l''article ' || article || ' de l''arrêté 2010-01-01</div>'
    || '<div data-spec="alinea" data-number="1">L''<a data-spec="section_reference" data-type="article" data-tag_id="r1" data-parent_reference="d1" data-start_num="' || article
    || '">article</a> de l''<a data-spec="document_reference" data-tag_id="d1" data-date="2010-01-01">arrêté</a> ' || CASE kind WHEN 0 THEN 'est remplacé par les dispositions suivantes : ' WHEN 1 THEN 'est abrogé. ' ELSE 'est complété par : ' END
    || '<q>' || text || '</q></div></section></main></article>', '' ORDER BY d) AS html FROM o GROUP BY 1),
c AS (SELECT aiot, string_agg('<li data-spec="permit_source" data-date="' || d || '" data-status="active"><p><strong>Date arrêté :</strong> ' || d || CASE WHEN page_id % 10 = 0 THEN ' <strong>(Arrêté principal)</strong>' ELSE '' END
    || '</p><div data-spec="permit_source_title" aria-label="' || d || '.html"><div>' || d || '.html</div></div></li>', '' ORDER BY d) AS html FROM t GROUP BY 1)
SELECT c.aiot, '<html><body><header data-spec="header"><div data-spec="permit_title"><h1>Permis d''Exploitation Consolidé</h1><p><strong>Code AIOT ICPE :</strong> ' || c.aiot
  || '</p></div><section data-spec="permit_sources"><h2>Arrêtés sources</h2><ul>' || c.html || '</ul></section><section data-spec="permit_visa"><details><summary><h2>Visas consolidés</h2></summary></details></section>'
  || '<section data-spec="permit_motif"><details><summary><h2>Considérants</h2></summary></details></section></header><main>' || s.html || '</main>'
  || coalesce('<section data-spec="permit_modifying_arretes"><h2>Arrêtés préfectoraux modificatifs</h2>' || m.html || '</section>', '') || '<footer></footer></body></html>' AS html
FROM c JOIN s ON s.aiot = c.aiot LEFT JOIN m ON m.aiot = c.aiot""")
def q_consolidated_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated permit of every site: header, articles with their history, modifying decrees with what became of their operations."""
    decrees = made_decrees(spark, sf_dir)
    return pipeline.consolidate(decrees, pipeline.tagged_operations(decrees)).permits


# Parts of documents --------------------------------------------------------------------------------

#: What stands before the reference and behind it; the operation: kind, direction, keyword, operand.
_VERBS: list[tuple[str | None, ...]] = [
    ("L'", " est abrogé.", "delete", "rtl", "abrogé", None),
    ("L'", " est remplacé par : <q>A</q>", "replace", "rtl", "remplacé", "A"),
    ("L'", " est annulé et remplacé par <q>B</q> puis <q>C</q>", "replace", "rtl", "annulé et remplacé", "B"),
    ("L'", " est ainsi modifié : <q><b>C</b></q>", "replace", "rtl", "modifié", "<b>C</b>"),
    ("L'", " est complété comme suit : <q>D</q>", "add", "rtl", "complété", "D"),
    ("L'", " est mis à jour.", "replace", "rtl", "mis à jour", None),
    ("L'", " est retiré.", "delete", "rtl", "retiré", None),
    ("L'", " est supprimé et remplacé par <table><tr><td>1</td></tr></table>", "replace", "rtl", "supprimé et remplacé", "<table><tr><td>1</td></tr></table>"),
    ("Le présent arrêté abroge l'", ".", "delete", "ltr", "abroge", None),
    ("Le présent arrêté modifie et complète l'", ".", "replace", "ltr", "modifie et complète", None),
    ("Sont insérés après l'", " : <q>E</q>", "add", "ltr", "insérés", "E"),
    ("Cet article remplace l'", ".", "replace", "ltr", "remplace", None),
    ("L'exploitant respecte l'", ".", None, None, None, None),
    ("Les prescriptions du titre remplacent l'", ".", None, None, None, None),
]


@registered(f"""
WITH v AS (SELECT p_partkey AS k, {", ".join(f"{sql_list([c[i] for c in _VERBS])}[1 + p_partkey % {len(_VERBS)}] AS {name}" for i, name in ((2, "operation_type"), (3, "direction"), (4, "keyword"), (5, "operand")))} FROM part)
SELECT CAST(k AS VARCHAR) AS aiot, CAST(k % 9 + 1 AS VARCHAR) AS source_article, '2011-02-03' AS target_arrete, CAST(k % 5 + 1 AS VARCHAR) || '.2' AS target_article, operation_type, direction, keyword, operand FROM v WHERE operation_type IS NOT NULL""")
def q_verb_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbs of change of every kind and voice with references and contents, a decree per part."""
    k = F.col("p_partkey")
    document = F.lit('<a data-spec="document_reference" data-tag_id="d" data-date="2011-02-03">arrêté du 3 février</a>')
    reference = F.concat(F.lit('<a data-spec="section_reference" data-type="article" data-tag_id="s" data-parent_reference="d" data-start_num="'), (k % 5 + 1).cast("string"), F.lit('.2">article</a> de l\''), document)
    html = F.concat(F.lit('<main><section data-spec="section" data-number="'), (k % 9 + 1).cast("string"), F.lit('"><div data-spec="alinea" data-number="1">'), case_of(k, [c[0] for c in _VERBS]), reference, case_of(k, [c[1] for c in _VERBS]), F.lit("</div></section></main>"))
    decrees = table(spark, sf_dir, "part").select(k.cast("string").alias("aiot"), F.lit("2020-01-01").alias("decree_id"), html.alias("html"))
    return tagging.tag_operations(decrees).select("aiot", "source_article", F.col("target_arrete"), F.col("start_num").alias("target_article"), "operation_type", "direction", "keyword", "operand")


@registered("""
WITH p AS (SELECT doc_id, range(1, 2 + doc_id % 4) AS r FROM documents)
SELECT doc_id, '<section data-spec="section" data-number="2"><div data-spec="alinea" data-number="1">a</div>' || array_to_string(list_transform(r, lambda i: '<div data-spec="alinea" data-number="' || (i + 1) || '">p' || i || '</div>'), '')
  || '<div data-spec="alinea" data-number="' || (len(r) + 2) || '">z</div></section>' || CASE WHEN doc_id % 3 = 0 THEN '<section data-number="3" data-spec="section" data-title="Noise" data-type="article"><h2 data-level="0" data-spec="section_title">Article 3 : Noise</h2><div data-spec="alinea" data-number="1">more</div></section>' ELSE '' END AS html FROM p""")
def q_quote_alineas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotations as numbered alineas; in every third document one opens the next article."""
    lines = F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 4 + 1).cast("int")), lambda i: F.concat(F.lit("<p>p"), i.cast("string"), F.lit("</p>")))
    opened = F.lit('<div data-spec="alinea"><blockquote><a data-spec="section_reference" data-type="article" data-start_num="3">Article 3</a> : Noise<br>more</blockquote></div>')
    html = F.concat(F.lit('<section data-spec="section" data-number="2"><div data-spec="alinea" data-number="1">a<blockquote>'), F.array_join(lines, ""), F.lit('</blockquote></div><div data-spec="alinea" data-number="2">z</div>'), F.when(F.col("doc_id") % 3 == 0, opened).otherwise(F.lit("")), F.lit("</section>"))
    return table(spark, sf_dir, "documents").select("doc_id", trees.quotes_to_alineas(html).alias("html"))


@registered("""
WITH o AS (SELECT o_orderkey, CAST(o_orderkey % 4 + 1 AS BIGINT) AS n, CASE WHEN o_orderkey % 7 = 6 THEN -1 ELSE CAST(o_orderkey % 7 AS BIGINT) END AS pos, list_transform(range(1, 2 + o_orderkey % 4), lambda i: '<div data-spec="alinea">x' || i || '</div>') AS xs FROM orders),
w AS (SELECT *, CASE WHEN pos = -1 THEN n WHEN pos BETWEEN 1 AND n THEN pos END AS k FROM o)
SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN array_to_string(xs[1:k - 1], '') || '<div data-spec="alinea">y</div>' || array_to_string(xs[k + 1:n], '') END AS replaced,
  CASE WHEN k IS NOT NULL THEN array_to_string(xs[1:k - 1], '') || array_to_string(xs[k + 1:n], '') END AS removed, CASE WHEN k IS NOT NULL THEN array_to_string(xs[1:k], '') || '<p>y</p>' || array_to_string(xs[k + 1:n], '') END AS inserted FROM w""")
def q_subtarget_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alinea at a position replaced, removed, and another put behind it; null where there is none."""
    lines = F.transform(F.sequence(F.lit(1), (F.col("o_orderkey") % 4 + 1).cast("int")), lambda i: F.concat(F.lit('<div data-spec="alinea">x'), i.cast("string"), F.lit("</div>")))
    at = F.when(F.col("o_orderkey") % 7 == 6, F.lit(-1)).otherwise((F.col("o_orderkey") % 7).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(lines, "").alias("h"), at.alias("at"), F.lit("ALINEA").alias("k"), F.lit("<p>y</p>").alias("p"), F.lit("y").alias("y"))
    return rows.select("o_orderkey", trees.changed("h", "k", "at", "y").alias("replaced"), trees.changed("h", "k", "at", F.lit(None).cast("string")).alias("removed"), trees.inserted("h", "k", "at", "p").alias("inserted"))


@registered("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '<b>go ' || doc_id || '</b> and  on</p><p>stop' WHEN 1 THEN 'and  on' WHEN 2 THEN '<b>go ' || doc_id || '</b> and  on' WHEN 3 THEN '<p>HALT ' || doc_id || '</p>' END AS operand FROM documents""")
def q_operand_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands between two markers that are given as they are, with other blanks, other tags, another case, or not there."""
    k = F.col("doc_id").cast("string")
    html = F.concat(F.lit("<p>x <b>go "), k, F.lit("</b> and  on</p><p>stop "), k, F.lit("</p><div><p>HALT "), k, F.lit("</p></div>"))
    kind = F.col("doc_id") % 5
    begin = F.when(kind == 0, F.concat(F.lit("<b>go "), k)).when(kind == 1, F.lit("and on")).when(kind == 2, F.concat(F.lit("go "), k, F.lit(" and on"))).when(kind == 3, F.concat(F.lit("halt <i>"), k, F.lit("</i>"))).otherwise(F.lit("go away"))
    end = F.when(kind == 0, F.lit("stop"))
    return table(spark, sf_dir, "documents").select("doc_id", trees.operand_between(F.lit(None).cast("string"), html, begin, end).alias("operand"))


@registered("""
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN '<h3>Title ' || doc_id || '</h3>' END AS title, '<p>body</p>' AS body, CASE WHEN doc_id % 2 = 0 THEN '<p>new</p>' ELSE '<h2>Other</h2><p>new</p>' END AS operand FROM documents""")
def q_section_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section found by its number, split into title and body, and an operand without the title repeated."""
    k = F.col("doc_id").cast("string")
    heading = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("<h3>Title "), k, F.lit("</h3>"))).otherwise(F.lit(""))
    inner = F.concat(F.lit('<section data-spec="section" data-number="'), k, F.lit('">'), heading, F.lit("<p>body</p></section>"))
    html = F.concat(F.lit('<main><section data-spec="section" data-number="no">other</section>'), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("</main><footer data-spec=\"appendix\">"), inner, F.lit("</footer>"))).otherwise(F.concat(inner, F.lit("</main>"))))
    number = F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit("APPENDIX:")).otherwise(F.lit("")), k)
    operand = F.concat(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<h2> title  "), k, F.lit("</h2>"))).otherwise(F.lit("<h2>Other</h2>")), F.lit("<p>new</p>"))
    parts = table(spark, sf_dir, "documents").select("doc_id", k.alias("k"), operand.alias("o"), trees.split_title(trees.find_section(html, number)).alias("s"))
    return parts.select("doc_id", "s.title", "s.body", trees.without_heading("o", F.concat(F.lit("<h3>Title "), "k", F.lit("</h3>"))).alias("operand"))


def answer_of(model: str, prompt: str) -> str:
    """A stand-in for a model: the k-th customer's changes, surer when asked by its second name."""
    k = int(prompt.partition("key ")[2].partition(".")[0])
    if k % 5 == 0:
        return "nothing to see"
    ops = [f'{{"operation_type": "replace", "source_article": "1", "target_arrete": "2010-01-01", "target_article": "{k % 3}", "new_content_start_marker": "text {k}", "new_content_end_marker": "end", "confidence_score": {40 + 10 * (i + k % 4)}}}' for i in range(k % 4)]
    return "Here: [" + ", ".join(ops) + "] done"


@registered("""
WITH c AS (SELECT c_custkey AS k, unnest(range(0, c_custkey % 4)) AS i FROM customer WHERE c_custkey % 5 <> 0)
SELECT CAST(k AS VARCHAR) AS aiot, CAST(i AS BIGINT) AS place, CAST(k % 3 AS VARCHAR) AS target_article, CAST(40 + 10 * (i + k % 4) AS BIGINT) AS confidence_score, 'text ' || k || ' to the end' AS operand,
  CAST(CASE WHEN 40 + 10 * (k % 4) < 60 THEN 2 ELSE 1 END AS BIGINT) AS attempt FROM c WHERE 40 + 10 * (i + k % 4) >= 60""")
def q_detection_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations that a stand-in model finds in a chunk per customer, with a second call for unsure replies."""
    k = F.col("c_custkey").cast("string")
    html = F.concat(F.lit("<p>key "), k, F.lit(". text "), k, F.lit(" to the end</p>"))
    chunks = table(spark, sf_dir, "customer").select(k.alias("aiot"), F.lit("2020-01-01").alias("decree_id"), F.lit(0).alias("chunk_index"), html.alias("html"))
    found = detection.detect(chunks, answer_of, CallSettings(min_interval=0.0), threshold=60, retry=True)
    return found.select("aiot", F.col("place").cast("long").alias("place"), "target_article", F.col("confidence_score").cast("long").alias("confidence_score"), "operand", F.col("attempt").cast("long").alias("attempt"))


# Detection in chunks, and changes that a model places -------------------------------------------------


def sectioned_decrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decree of three sections per page, each with the page's whole text and an image, five to a site."""
    n = F.col("page_id")
    text = F.regexp_replace("html", "<[^>]*>", " ")
    text = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    section = lambda k: F.concat(F.lit(f'<section data-spec="section" data-number="{k}"> <h2 data-spec="section_title">T</h2> <p>start {k}</p>'), text, F.lit('<img src="i'), n.cast("string"), F.lit(f'.png"/><p>stop {k}</p></section>'))
    html = F.concat(F.lit("<main>"), *(section(k) for k in (1, 2, 3)), F.lit("</main>"))
    return table(spark, sf_dir, "pages").select(F.floor(n / 5).cast("string").alias("aiot"), F.concat(F.lit("20"), (n % 5 + 10).cast("string"), F.lit("-01-01")).alias("decree_id"), html.alias("html"))


def changes_of(model: str, prompt: str) -> str:
    """A stand-in for a model: a change for each section of a chunk, the third of no kind, the second unsure in chunks of some lengths."""
    import json
    import re

    chunk = prompt.partition("<decree>")[2]
    numbers = re.findall(r'<section data-spec="section" data-number="(\d)">', chunk)
    unsure = len(chunk) % 3 == 0
    ops = [{"operation_type": "AUTRE" if k == "3" else "replace", "source_article": k, "target_arrete": "2010-01-01", "target_article": k, "new_content_start_marker": f"start  {k}", "new_content_end_marker": f"<p>STOP {k}", "confidence_score": 70 if k == "2" and unsure else 90} for k in numbers]
    return "```json\n" + json.dumps(ops) + "\n```"


@registered("""
WITH p AS (SELECT page_id AS n, regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\\s{2,}', ' ', 'g') AS t FROM pages),
b AS (SELECT n, t, list_transform([1, 2, 3], lambda k: '<section data-spec="section" data-number="' || k || '"><h2 data-spec="section_title">T</h2><p>start ' || k || '</p>' || t || 'IMG_00' || k || '<p>stop ' || k || '</p></section>') AS s FROM p WHERE n % 5 <> 0),
z AS (SELECT *, list_transform(s, lambda x: length(x)) AS l, length('<main></main>' || s[1] || s[2] || s[3]) AS whole FROM b),
g AS (SELECT *, CAST(ceil(whole / greatest(1, ceil(whole / 2500.0))) AS BIGINT) AS goal FROM z),
c2 AS (SELECT *, CASE WHEN l[1] >= goal THEN 1 ELSE 0 END AS second, CASE WHEN l[1] >= goal THEN 0 ELSE l[1] END + l[2] >= goal AS full2 FROM g),
c AS (SELECT *, second + CASE WHEN full2 THEN 1 ELSE 0 END AS third FROM c2),
k AS (SELECT n, t, k, CASE k WHEN 1 THEN 0 WHEN 2 THEN second ELSE third END AS chunk, s, second, third FROM c, (SELECT unnest([1, 2, 3]) AS k)),
x AS (SELECT n, chunk, sum(length(s[k])) AS size FROM k GROUP BY 1, 2),
u AS (SELECT k.*, x2.size AS size2, (x2.size + length('</decree>') + 2) % 3 = 0 AS unsure FROM k JOIN x x2 ON x2.n = k.n AND x2.chunk = k.second)
SELECT CAST(n // 5 AS VARCHAR) AS aiot, '20' || CAST(n % 5 + 10 AS VARCHAR) || '-01-01' AS decree_id, CAST(chunk AS BIGINT) AS chunk_index, CAST(k AS VARCHAR) AS source_article, CASE WHEN k = 3 THEN 'autre' ELSE '' END AS reject_reason,
  CAST(CASE WHEN unsure AND chunk = second THEN 2 ELSE 1 END AS BIGINT) AS attempt, CASE WHEN k < 3 THEN 'start ' || k || '</p>' || t || '<img src="i' || n || '.png"/><p>stop ' || k END AS operand
FROM u WHERE NOT (k = 2 AND unsure)""")
def q_detection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From whole decrees to chunks, prompts, checked replies and operands with their images; rejected objects with their reason."""
    found = detection.of_decrees(sectioned_decrees(spark, sf_dir), changes_of, CallSettings(min_interval=0.0), threshold=80, retry=True, soft=2500)
    keys = ["aiot", "decree_id", F.col("chunk_index").cast("long").alias("chunk_index")]
    ops = found.operations.select(*keys, "source_article", F.lit("").alias("reject_reason"), F.col("attempt").cast("long").alias("attempt"), "operand")
    out = found.rejected.select(*keys, F.get_json_object("op", "$.source_article").alias("source_article"), "reject_reason", F.col("attempt").cast("long").alias("attempt"), F.lit(None).cast("string").alias("operand"))
    return ops.unionByName(out)


def placed_by(model: str, prompt: str) -> str:
    """A stand-in for a model: the target's text with the part and the new content behind it."""
    cut = lambda name: prompt.partition(f"<{name}>\n")[2].partition(f"\n</{name}>")[0]
    return f"```html\n{cut('target')} [{cut('part')}: {cut('content') or 'gone'}]\n```"


@registered("""
WITH o AS (SELECT CAST(c_nationkey AS VARCHAR) AS aiot, c_custkey AS k, c_name AS name FROM customer)
SELECT aiot, CAST(k AS VARCHAR) AS article_id, CAST(v AS BIGINT) AS version, CASE v WHEN 0 THEN name WHEN 1 THEN name || CASE k % 3 WHEN 0 THEN ' [first line: x' || k || ']' WHEN 1 THEN ' [first line: gone]' ELSE '' END
  ELSE name || CASE k % 3 WHEN 0 THEN ' [first line: x' || k || ']' WHEN 1 THEN ' [first line: gone]' ELSE '' END || CASE WHEN k % 3 = 2 THEN '' ELSE ' [second line: y' || k || ']' END END AS content,
  CASE WHEN k % 3 = 2 AND v = 1 THEN 'error_extracting_source' WHEN k % 3 = 2 AND v = 2 THEN 'propagated_error' ELSE '' END AS codes FROM o, (SELECT unnest([0, 1, 2]) AS v)""")
def q_model_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article per customer with two changes in a row that only a model can place; a third of them have no source."""
    k, site = F.col("c_custkey"), F.col("c_nationkey").cast("string").alias("aiot")
    rows = table(spark, sf_dir, "customer")
    articles = rows.select(site, F.lit("2010-01-01").alias("decree_id"), k.cast("string").alias("article_id"), F.lit(0).alias("pos"), F.lit("").alias("title"), F.col("c_name").alias("content"))
    nth = F.explode(F.array(F.lit(0), F.lit(1))).alias("nth")
    ops = rows.select(site, k.alias("k"), nth).select(
        "aiot", (F.col("k") * 2 + F.col("nth")).cast("long").alias("seq"), F.concat(F.lit("op"), F.col("k") * 2 + F.col("nth")).alias("id"), F.concat(F.lit("201"), F.col("nth") + 1, F.lit("-01-01")).alias("source_decree"), F.lit("1").alias("source_article"),
        F.lit("2010-01-01").alias("target_decree"), F.col("k").cast("string").alias("target_article"), F.when((F.col("nth") == 0) & (F.col("k") % 3 == 1), "REMOVE").when(F.col("nth") == 0, "REPLACE").otherwise("ADD").alias("operation_type"),
        F.when(~((F.col("nth") == 0) & (F.col("k") % 3 == 1)), F.concat(F.when(F.col("nth") == 0, "x").otherwise("y"), F.col("k").cast("string"))).alias("operand"), F.lit("COMPLEX").alias("sub_type"), F.lit(None).cast("int").alias("sub_position"),
        F.when(F.col("nth") == 0, "first line").otherwise("second line").alias("sub_description"), F.when((F.col("k") % 3 == 2) & (F.col("nth") == 0), F.array(F.lit("error_extracting_source"))).otherwise(F.expr("cast(array() as array<string>)")).alias("error_codes"), F.lit(False).alias("abrogates"),
    )
    done = replay.run(ops, articles, call=placed_by, settings=CallSettings(min_interval=0.0, batch=10**6))
    return done.versions.select("aiot", "article_id", F.col("version").cast("long").alias("version"), "content", F.array_join("error_codes", ",").alias("codes"))


# Merged, numbered, counted, written ---------------------------------------------------------------


@registered("""
WITH b AS (SELECT l_suppkey % 20 AS aiot, l_linenumber - 1 AS side, l_orderkey * 10000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS s, 'op' || (l_orderkey % 97) AS id, l_orderkey % 11 AS sd, l_partkey % 7 AS td, l_partkey % 13 AS ta, l_returnflag AS t,
    CASE WHEN l_quantity < 15 THEN NULL WHEN l_quantity < 30 THEN 'FULL_SECTION' ELSE 'ALINEA' END AS st, CASE WHEN l_quantity >= 30 THEN l_quantity % 2 END AS pos FROM lineitem WHERE l_linenumber <= 2),
n AS (SELECT *, row_number() OVER (PARTITION BY aiot ORDER BY side, s) AS seq, coalesce(st, 'FULL_SECTION') = 'FULL_SECTION' AS f FROM b),
w AS (SELECT *, max(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY aiot, sd, td, ta) AS precise,
    row_number() OVER (PARTITION BY aiot, sd, td, ta, f, CASE WHEN f THEN NULL ELSE st END, CASE WHEN f THEN NULL ELSE pos END, t ORDER BY seq) AS k FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY aiot, id ORDER BY seq) AS nth FROM w WHERE k = 1 AND NOT (f AND precise = 1))
SELECT CAST(aiot AS VARCHAR) AS aiot, seq, id || CASE WHEN nth > 1 THEN '_' || nth ELSE '' END AS id FROM r""")
def q_merged_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations of two origins as one numbered table without redundant ones and with ids of their own."""
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 20).cast("string").alias("aiot"), F.col("l_linenumber").alias("n"), (F.col("l_orderkey").cast("long") * 10000000 + F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")).alias("seq"), F.concat(F.lit("op"), F.col("l_orderkey") % 97).alias("id"),
        (F.col("l_orderkey") % 11).cast("string").alias("source_decree"), F.lit("1").alias("source_article"), (F.col("l_partkey") % 7).cast("string").alias("target_decree"), (F.col("l_partkey") % 13).cast("string").alias("target_article"),
        F.col("l_returnflag").alias("operation_type"), F.when(q < 15, None).when(q < 30, "FULL_SECTION").otherwise("ALINEA").alias("sub_type"), F.when(q >= 30, (q % 2).cast("int")).alias("sub_position"),
    )
    sides = [rows.where(F.col("n") == k).drop("n") for k in (1, 2)]
    return relations.merged(*sides).select("aiot", "seq", "id")


@registered("""
WITH p AS (SELECT page_id AS n, replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM pages),
b AS (SELECT p.n // 3 AS g, coalesce('<p>' || x.t || '</p>', '') || coalesce('<p>' || y.t || '</p>', '') AS held FROM p LEFT JOIN p x ON x.n = p.n + 2 LEFT JOIN p y ON y.n = p.n + 1 WHERE p.n % 3 = 0)
SELECT CAST(g AS VARCHAR) AS aiot, CASE g % 3 WHEN 0 THEN '<body><main>b</main><footer data-spec="appendix">f' || held || '</footer></body>'
  WHEN 1 THEN '<body><main>b</main>' || CASE WHEN held = '' THEN '' ELSE '<footer data-spec="appendix">' || held || '</footer>' END || '</body>' ELSE '<body>b' || CASE WHEN held = '' THEN '' ELSE '<footer data-spec="appendix">' || held || '</footer>' END || '</body>' END AS html FROM b""")
def q_annex_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decrees with what two annexes of their date hold, whole pages, in their appendix."""
    n = F.col("page_id")
    group = F.floor(n / 3)
    text = F.regexp_replace("html", "<[^>]*>", " ")
    text = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    base = F.when(group % 3 == 0, '<body><main>b</main><footer data-spec="appendix">f</footer></body>').when(group % 3 == 1, "<body><main>b</main></body>").otherwise("<body>b</body>")
    html = F.when(n % 3 == 0, base).otherwise(F.concat(F.lit("x<main><p>"), text, F.lit("</p></main>y")))
    name = F.when(n % 3 == 0, "2010-01-01.html").when(n % 3 == 1, "2010-01-01_annexe 2.html").otherwise("2010-01-01_Annexe 1.html")
    files = table(spark, sf_dir, "pages").select(group.cast("string").alias("aiot"), name.alias("filename"), F.lit("2010-01-01").alias("decree_id"), F.lit("AUTRE").alias("file_type"), html.alias("html"))
    return relations.one_decree_a_date(files).select("aiot", "html")


@registered("""
WITH n AS (SELECT count(*) FILTER (page_id % 10 = 0) AS f, count(*) FILTER (page_id % 10 <> 0) AS o FROM pages)
SELECT unnest(['decrees', 'tagged', 'articles', 'operations', 'versions', 'skipped']) AS stage, unnest([f + o, o, 2 * f + o, o, 2 * f + 2 * o, 0]) AS n_rows FROM n""")
def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every stage of the whole plan, counted while they are written."""
    counts: dict[str, int] = {}
    pipeline.run(made_decrees(spark, sf_dir), render=False, counts=counts)
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows long")


@registered("""
WITH l AS (SELECT CAST(l_suppkey % 10 AS VARCHAR) AS aiot, l_orderkey % 13 AS a, l_linenumber AS b, l_partkey % 7 AS c, l_returnflag AS t, l_quantity AS q, l_tax AS tax FROM lineitem WHERE l_suppkey % 10 < 9),
k AS (SELECT aiot, a, b, c, t, sum(CASE WHEN q < 30 AND tax <> 0 THEN 1 ELSE 0 END) AS d, sum(CASE WHEN q >= 20 THEN 1 ELSE 0 END) AS g FROM l GROUP BY ALL),
s AS (SELECT coalesce(aiot, 'TOTAL') AS aiot, sum(least(d, g)) AS tp, sum(d) AS nd, sum(g) AS ng FROM k GROUP BY GROUPING SETS ((aiot), ())),
x AS (SELECT coalesce(aiot, 'TOTAL') AS aiot, count(*) FILTER (q >= 20) AS truth, count(*) FILTER (q < 30) AS detected, count(*) FILTER (q < 30 AND tax <> 0) AS validated, sum(q) / 4.0 AS seconds, sum(q) AS ti, sum(b) AS tos,
    sum(CASE b % 3 WHEN 0 THEN q * 1.0 + b * 2.0 WHEN 1 THEN q * 0.5 + b * 1.5 ELSE 0 END) / 1e6 AS cost FROM l GROUP BY GROUPING SETS ((aiot), ())),
r AS (SELECT s.*, CAST(tp AS DOUBLE) / nd AS p, CAST(tp AS DOUBLE) / ng AS r FROM s)
SELECT r.aiot, truth, detected, validated, CAST(tp AS BIGINT) AS tp, CAST(nd - tp AS BIGINT) AS fp, CAST(ng - tp AS BIGINT) AS fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1, CAST(seconds AS DOUBLE) AS seconds,
  CAST(ti AS BIGINT) AS tokens_in, CAST(tos AS BIGINT) AS tokens_out, round(cost, 4) AS cost FROM r JOIN x ON x.aiot = r.aiot""")
def q_score_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourteen columns of an evaluation, by site and in all; a site without ground truth is left out."""
    site = (F.col("l_suppkey") % 10).cast("string").alias("aiot")
    kind = F.when(F.col("l_returnflag") == "R", "REMOVE").when(F.col("l_returnflag") == "A", "ADD").otherwise("REPLACE").alias("operation_type")
    text = lambda c, name: c.cast("string").alias(name)
    rows = table(spark, sf_dir, "lineitem").select(site, text(F.col("l_orderkey") % 13, "source_decree"), text(F.col("l_linenumber"), "source_article"), text(F.col("l_partkey") % 7, "target_decree"), F.lit("1").alias("target_article"), kind, F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("b"), F.col("l_tax").alias("tax"))
    codes = F.when(F.col("tax") == 0, F.array(F.lit("less_important"))).otherwise(F.expr("cast(array() as array<string>)"))
    detected = rows.where("q < 30").withColumn("error_codes", codes)
    usage = rows.select("aiot", F.concat(F.lit("m"), F.col("b") % 3).alias("model"), F.col("q").cast("long").alias("tokens_in"), F.col("b").cast("long").alias("tokens_out"))
    rates = spark.createDataFrame([("m0", 1.0, 2.0), ("m1", 0.5, 1.5)], "model string, cost_in double, cost_out double")
    sheet = evaluation.sheet(detected, detected, rows.where("q >= 20 and aiot <> '9'"), usage, rates, rows.select("aiot", (F.col("q") / 4).cast("double").alias("seconds")))
    return sheet.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")} | {"cost": F.round("cost", 4)})


@registered("""
WITH c AS (SELECT CAST(c_nationkey AS VARCHAR) AS aiot, c_custkey AS k, c_name AS name FROM customer),
o AS (SELECT aiot, '[' || chr(10) || string_agg('  {' || chr(10) || CASE WHEN k % 2 = 0 THEN '    "confidence_score": 80,' || chr(10) ELSE '' END || CASE WHEN k % 3 = 0 THEN '    "error_codes": [' || chr(10) || '      "less_important"' || chr(10) || '    ],' || chr(10) ELSE '' END
    || '    "id": "op' || k || '",' || chr(10) || '    "operand": "<p class=\\"é\\">' || name || '</p>",' || chr(10) || '    "operation_type": "ADD",' || chr(10) || '    "origin": "Regex",' || chr(10) || '    "source_id": {' || chr(10) || '      "arrete_id": "2012-01-01",' || chr(10)
    || '      "article_id": "1"' || chr(10) || '    },' || chr(10) || '    "target_id": {' || chr(10) || '      "arrete_id": "2010-01-01",' || chr(10) || '      "article_id": "' || k || '"' || chr(10) || '    }' || chr(10) || '  }', ',' || chr(10) ORDER BY k) || chr(10) || ']' || chr(10) AS text FROM c WHERE aiot <> '3' GROUP BY 1),
h AS (SELECT aiot, '{' || chr(10) || string_agg('  "2010-01-01#' || k || '": [' || chr(10) || '    {' || chr(10) || '      "content": "' || name || '",' || chr(10) || '      "operation_id": null,' || chr(10) || '      "title": "",' || chr(10) || '      "version": 0' || chr(10) || '    }' || chr(10) || '  ]', ',' || chr(10) ORDER BY '2010-01-01#' || k) || chr(10) || '}' || chr(10) AS text FROM c GROUP BY 1)
SELECT aiot, 'operations.json' AS filename, text FROM o UNION ALL SELECT DISTINCT aiot, 'operations.json', '[]' || chr(10) FROM c WHERE aiot = '3'
UNION ALL SELECT aiot, 'history.json', text FROM h UNION ALL SELECT aiot, 'permis.html', string_agg(name, '' ORDER BY k) FROM c GROUP BY 1""")
def q_site_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of operations, versions and permits, a folder a site, as they read after they were written."""
    k, site = F.col("c_custkey"), F.col("c_nationkey").cast("string").alias("aiot")
    rows = table(spark, sf_dir, "customer").select(site, k.alias("k"), F.col("c_name").alias("name"))
    ops = rows.where("aiot <> '3'").select(
        "aiot", F.col("k").cast("long").alias("seq"), F.concat(F.lit("op"), "k").alias("id"), F.lit("Regex").alias("origin"), F.lit("2012-01-01").alias("source_decree"), F.lit("1").alias("source_article"), F.lit("2010-01-01").alias("target_decree"), F.col("k").cast("string").alias("target_article"),
        F.lit("ADD").alias("operation_type"), F.concat(F.lit('<p class="é">'), "name", F.lit("</p>")).alias("operand"), F.lit(None).cast("string").alias("sub_type"), F.lit(None).cast("int").alias("sub_position"), F.lit(None).cast("string").alias("sub_description"),
        F.when(F.col("k") % 3 == 0, F.array(F.lit("less_important"))).otherwise(F.expr("cast(array() as array<string>)")).alias("error_codes"), F.when(F.col("k") % 2 == 0, 80).alias("confidence_score"),
    )
    versions = rows.select("aiot", F.lit("2010-01-01").alias("decree_id"), F.col("k").cast("string").alias("article_id"), F.lit(0).alias("version"), F.lit("").alias("title"), F.col("name").alias("content"), F.lit(None).cast("string").alias("operation_id"), F.expr("cast(array() as array<string>)").alias("error_codes"))
    permits = rows.select("aiot", F.lit("permis.html").alias("filename"), F.col("k").cast("long").alias("nth"), F.col("name").alias("text"))
    path = f"{shared_folder(spark)}/sites-{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    site_files.write(sinks.operations_file(ops, rows).unionByName(sinks.history_file(versions, rows)).unionByName(permits), path)
    return site_files.read(spark, path)


@registered("""
WITH RECURSIVE t AS (SELECT c_custkey AS tag, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey - 1 - c_custkey % 2 END AS parent, c_nationkey % 3 AS g FROM customer WHERE c_custkey > 2),
r(tag, g, root, steps) AS (SELECT tag, g, tag, 0 FROM t UNION ALL SELECT r.tag, r.g, t.parent, r.steps + 1 FROM r JOIN t ON t.tag = r.root AND t.g = r.g WHERE t.parent IS NOT NULL)
SELECT CAST(g AS VARCHAR) AS decree_id, CAST(r.tag AS VARCHAR) AS tag_id, CAST(root AS VARCHAR) AS root, CAST(steps AS BIGINT) AS steps FROM r
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.tag = r.root AND t.g = r.g AND t.parent IS NOT NULL)""")
def q_reference_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References followed to the end of their chains of parents, within each decree."""
    k = F.col("c_custkey")
    parent = F.when(k % 5 != 0, (k - 1 - k % 2).cast("string"))
    rows = table(spark, sf_dir, "customer").where("c_custkey > 2").select((F.col("c_nationkey") % 3).cast("string").alias("decree_id"), k.cast("string").alias("tag_id"), parent.alias("parent_ref"))
    return trees.resolve_documents(rows, "decree_id").select("decree_id", "tag_id", "root", F.col("steps").cast("long").alias("steps"))


@registered("""
WITH s AS (SELECT page_id, k FROM pages, (SELECT unnest([1, 2, 3]) AS k))
SELECT page_id, CASE WHEN k = 3 THEN 'APPENDIX:' ELSE '' END || k AS article_id, CASE k WHEN 2 THEN '1' END AS holder, CAST(CASE WHEN k = 3 THEN 1 ELSE 3 - k END AS BIGINT) AS n_links FROM s""")
def q_section_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of sections, the number of the section around each, and the links inside each, from the node table of decrees made from the pages."""
    text = F.replace(F.regexp_replace("html", "<[^>]*>", " "), F.lit("<"), F.lit(""))
    section = lambda k, inner: F.concat(F.lit(f'<section data-spec="section" data-number="{k}"><a data-spec="link">'), text, F.lit("</a>"), inner, F.lit("</section>"))
    html = F.concat(F.lit("<main>"), section(1, section(2, F.lit(""))), F.lit('</main><footer data-spec="appendix">'), section(3, F.lit("")), F.lit("</footer>"))
    nodes = stored(trees.nodes(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id"), "nodes")
    sections = trees.section_ids(nodes, "page_id").select("page_id", "node_id", "article_id")
    around = trees.enclosing(trees.of_spec(nodes, "section"), trees.of_spec(nodes, "section"), "page_id")
    links = trees.inside(trees.of_spec(nodes, "link"), sections, "page_id").groupBy("page_id", F.col("holder").alias("node_id")).agg(F.count("*").alias("n_links"))
    named = sections.select("page_id", F.col("node_id").alias("holder"), F.col("article_id").alias("holder_id"))
    rows = sections.join(around, ["page_id", "node_id"], "left").join(named, ["page_id", "holder"], "left").join(links, ["page_id", "node_id"], "left")
    return rows.select("page_id", "article_id", F.col("holder_id").alias("holder"), "n_links")


@registered("""
WITH f AS (SELECT page_id % 20 AS aiot, page_id || '.html' AS name, trim(regexp_replace(html, '(?m)[ \\t]+$', '', 'g'), ' ') AS html FROM pages)
SELECT CAST(aiot AS VARCHAR) AS aiot, '<tr><td>' || aiot || '</td><td>' || string_agg('<a href="' || md5(html) || '">' || name || '</a>', ' ' ORDER BY name) || '</td></tr>' AS row FROM f GROUP BY aiot""")
def q_site_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table row a site with links to its pages, named by the checksum of their normal form."""
    rows = table(spark, sf_dir, "pages").select((F.col("page_id") % 20).cast("string").alias("aiot"), F.concat("page_id", F.lit(".html")).alias("filename"), F.md5(sinks.normal_html(F.col("html"))).alias("path"))
    return sinks.index_rows(rows)
