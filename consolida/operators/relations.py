"""Set forms of the relational operators: duplicates, redundancy, conflicts, reachability, order."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consolida.functions.identifiers import is_annexe, kind_rank, not_a_decree, sort_key
from consolida.operators.trees import outline
from consolida.operators.validation import is_full_removal
from consolida.plans.storage import bucketed, stored


#: Tables of steps that are merged into one (fixed value).
MERGED = 6


def first_by(rows: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def one_decree_a_date(files: DataFrame) -> DataFrame:
    """Per date the decree of the best kind, the first by name within it, with what its date's annexes hold in its appendix.

    ``files``: aiot, filename, decree_id, file_type, html.  Where a date has
    annexes only, the first of them is the decree.
    """
    kept = files.where(~not_a_decree(F.col("filename"))).withColumn("annexe", is_annexe(F.col("filename")))
    order = Window.partitionBy("aiot", "decree_id").orderBy("annexe", kind_rank(F.col("file_type")), "filename")
    ranked = kept.withColumn("_n", F.row_number().over(order))
    return with_annexes(ranked.where("_n = 1").drop("_n"), ranked.where("annexe and _n > 1"))


def with_annexes(decrees: DataFrame, annexes: DataFrame) -> DataFrame:
    """Decrees whose appendix also holds the main parts of the annexes of their date, in order of name.

    A decree without an appendix gets one behind its main part, else at the end
    of its body, else at its end.  Annexes without a main part are left out.
    """
    keys = ["aiot", "decree_id"]
    mains = outline(annexes, *keys, "filename").where("kind = 'main'").select(*keys, "filename", "open_end", "close")
    parts = annexes.select(*keys, "filename", "html").join(mains, [*keys, "filename"]).select(*keys, "filename", F.expr("substring(html, open_end + 1, close - open_end)").alias("part"))
    held = parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("filename", "part"))), lambda p: p["part"]), "").alias("_held"))
    touched = decrees.join(held.select(*keys), keys, "left_semi")
    places = outline(touched, *keys).groupBy(*keys).agg(F.max(F.when(F.col("kind") == "appendix", F.col("close"))).alias("_in"), F.max(F.when(F.col("kind") == "main", F.col("end"))).alias("_behind"))
    rows = decrees.join(held, keys, "left").join(places, keys, "left")
    body_end = F.length("html") - F.nullif(F.instr(F.reverse(F.lower("html")), F.lit(">ydob/<")), F.lit(0)) - 6
    at = F.coalesce("_in", "_behind", body_end, F.length("html"))
    text = F.when(F.col("_in").isNotNull(), F.col("_held")).otherwise(F.concat(F.lit('<footer data-spec="appendix">'), "_held", F.lit("</footer>")))
    html = F.concat(F.substring("html", F.lit(1), at), text, F.substring("html", at + 1, F.length("html")))
    return rows.withColumn("html", F.when(F.col("_held").isNull(), F.col("html")).otherwise(html)).drop("_held", "_in", "_behind")


def decree_duplicates(files: DataFrame) -> DataFrame:
    """Files that another file of their date replaces, and whether they equal it."""
    order = Window.partitionBy("aiot", "decree_id").orderBy(kind_rank(F.col("file_type")), "filename")
    rows = files.where(~not_a_decree(F.col("filename")) & ~is_annexe(F.col("filename"))).withColumn("_n", F.row_number().over(order))
    rows = rows.withColumn("keeper", F.first("filename").over(order)).withColumn("identical", F.md5("html") == F.first(F.md5("html")).over(order))
    return rows.where("_n > 1").select("aiot", "decree_id", "filename", "keeper", "identical")


def without_redundant(ops: DataFrame, keys: Sequence[str] = ("source_decree", "source_article", "target_decree", "target_article"), seq: str = "seq") -> DataFrame:
    """The most precise operations of each source and target.

    Any operation on part of an article displaces all those on the whole of it;
    of equal scope and type the first by ``seq`` stays.
    """
    full = F.coalesce(F.col("sub_type") == "FULL_SECTION", F.lit(True))
    rows = ops.repartition(*keys).withColumn("_full", full)
    scope = Window.partitionBy(*keys, "_full", F.when(~full, F.col("sub_type")), F.when(~full, F.col("sub_position")), "operation_type").orderBy(seq)
    rows = rows.withColumn("_n", F.row_number().over(scope)).where("_n = 1")
    rows = rows.withColumn("_precise", F.max((~F.col("_full")).cast("int")).over(Window.partitionBy(*keys)))
    return rows.where("not (_full and _precise = 1)").drop("_full", "_precise", "_n")


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their number from 1 within ``keys``, in the given order, whatever the size of a key.

    All rows are sorted by ranges; a row's number is its place behind the first
    of its key in its partition, and what the partitions before hold of the key.
    """
    ranged = [*(F.col(k).asc_nulls_first() for k in keys), *(F.col(c).asc_nulls_first() for c in order)]
    placed = rows.repartitionByRange(*ranged).sortWithinPartitions(*ranged).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed, "numbered").withColumn("_part", F.shiftright("_at", 33))
    starts = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.withColumn("_before", F.coalesce(before, F.lit(0))).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), "_first", "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    met = placed.join(starts, [*same, F.col("_part") == F.col("_p")])
    return met.withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1).select(*rows.columns, *([name] if name not in rows.columns else []))


def merged(reference: DataFrame, candidates: DataFrame) -> DataFrame:
    """Operations found in two ways as one table, the first ones before the others.

    Of each source and target the most precise stay; ``seq`` counts on within an
    aiot; of operations with one id the first keeps it, the k-th has ``_k`` behind it.
    """
    both = reference.withColumn("_side", F.lit(0)).unionByName(candidates.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    both = numbered(both, ["aiot"], ["_side", "seq", "id"], "_seq").drop("_side").withColumn("seq", F.col("_seq")).drop("_seq")
    kept = without_redundant(both, ("aiot", "source_decree", "source_article", "target_decree", "target_article"))
    while True:
        nth = F.row_number().over(Window.partitionBy("aiot", "id").orderBy("seq"))
        kept = stored(kept.withColumn("_nth", nth).withColumn("id", F.when(F.col("_nth") > 1, F.concat("id", F.lit("_"), "_nth")).otherwise(F.col("id"))), "merged")
        if kept.where("_nth > 1").isEmpty():  # new ids may meet others
            return kept.drop("_nth")
        kept = kept.drop("_nth")


def article_lookup(ops: DataFrame, articles: DataFrame, side: str) -> DataFrame:
    """Title and content of the article on one side of each operation; the first of several with one number."""
    first = first_by(articles, ["aiot", "decree_id", "article_id"], "pos")
    named = first.select("aiot", F.col("decree_id").alias(f"{side}_decree"), F.col("article_id").alias(f"{side}_article"), F.col("title").alias(f"{side}_title"), F.col("content").alias(f"{side}_content"))
    return ops.join(named, ["aiot", f"{side}_decree", f"{side}_article"], "left")


def classify(ops: DataFrame, decrees: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """Operations with the codes of the first conflict, in a fixed order of precedence.

    ``decrees``: aiot, decree_id, principal.  Also gives ``abrogates`` where an
    operation takes its target decree out of force.
    """
    known = decrees.select("aiot", F.col("decree_id").alias("target_decree"), F.lit(True).alias("_there"), F.col("principal").alias("_principal"))
    rows = ops.join(known, ["aiot", "target_decree"], "left")
    removal = is_full_removal()
    pair = Window.partitionBy("aiot", "source_decree", "target_decree")
    rows = rows.withColumn("_removal", removal).withColumn("_others", F.max((~F.col("_removal")).cast("int")).over(pair))
    there, skip = F.col("_there").isNotNull(), F.array_contains("error_codes", "not_an_operation")
    code = (
        F.when(skip, F.lit(None))
        .when(F.col("_removal") & F.coalesce(F.col("_principal"), F.lit(False)), F.lit("error_extracting_target"))
        .when(F.col("_removal") & (F.col("_others") == 1), F.lit("less_important"))
        .when(~there, F.lit("missing_arrete"))
    )
    if articles is not None:
        rows = article_lookup(article_lookup(rows, articles, "target"), articles, "source")
        fresh = F.col("target_article").startswith("NEW_ARTICLE") | F.col("target_article").isin("ALL", "END")
        code = code.when(F.col("_removal") | skip, F.lit(None)).when(~fresh & F.col("target_content").isNull(), F.lit("error_extracting_target")).when((F.col("source_article") != "ALL") & F.col("source_content").isNull(), F.lit("error_extracting_source"))
    rows = rows.withColumn("_code", code)
    codes = F.array_sort(F.array_distinct(F.array_compact(F.concat("error_codes", F.array("_code")))))
    return rows.withColumn("abrogates", F.col("_removal") & F.col("_code").isNull()).withColumn("error_codes", codes).drop("_there", "_principal", "_removal", "_others", "_code")


def nodes_and_edges(ops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles and operations as a directed multigraph; parallel edges are numbered from 0."""
    ends = [ops.select("aiot", F.col(f"{s}_decree").alias("decree_id"), F.col(f"{s}_article").alias("article_id"), "seq") for s in ("source", "target")]
    nodes = ends[0].unionByName(ends[1]).groupBy("aiot", "decree_id", "article_id").agg(F.min("seq").alias("first_seq"))
    parallel = Window.partitionBy("aiot", "source_decree", "source_article", "target_decree", "target_article").orderBy("seq")
    return nodes, ops.withColumn("key", F.row_number().over(parallel) - 1)


def downstream(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, node, steps) of all nodes that can be reached along ``edges`` (src, dst), each by its shortest way.

    One join per step over the newest nodes only.  Links are stored once, and
    what was reached in buckets of seed and node, so a step shuffles the newest
    nodes and those ahead of them, and nothing that was reached before.  Every
    ``MERGED`` tables of steps become one, and as many of those one again.
    """
    keys = ["seed", "node"]
    links = stored(edges.select("src", "dst").distinct(), "links")
    newest = bucketed(seeds.select(F.col("node").alias("seed"), "node", F.lit(0).alias("steps")).dropDuplicates(keys), "reached", *keys)
    seen = [[newest]]  # tables by how often they were merged
    for step in itertools.count(1):
        fresh = newest.join(links, newest["node"] == links["src"]).select("seed", F.col("dst").alias("node")).distinct()
        for table in itertools.chain.from_iterable(seen):
            fresh = fresh.join(table.select(*keys).hint("merge"), keys, "left_anti")
        newest = bucketed(fresh.withColumn("steps", F.lit(step)), "reached", *keys)
        if newest.isEmpty():
            return functools.reduce(DataFrame.unionByName, itertools.chain.from_iterable(seen))
        seen[0].append(newest)
        for level in itertools.takewhile(lambda level: len(seen[level]) >= MERGED, itertools.count()):
            whole = bucketed(functools.reduce(DataFrame.unionByName, seen[level]).repartition(*keys), "reached", *keys)
            seen[level] = []
            if level + 1 == len(seen):
                seen.append([])
            seen[level + 1].append(whole)


def covered(flag: Column) -> Column:
    """Whether a section lies inside an earlier one that ``flag`` is true of: sections nest, so the farthest end tells."""
    before = Window.partitionBy("aiot", "decree_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.max(F.when(flag, F.col("end"))).over(before) > F.col("start"), F.lit(False))


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that ``edges`` (a, b) connect with another; component: the least node of them.

    In each round every node hangs its greater neighbours below the least node
    it knows, then all its neighbours below the least of the others.  Only
    minima are gathered, and the number of rounds grows with the logarithm of
    the longest chain.
    """
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "pairs")
    before, now = None, _fingerprint(pairs)
    while now[0] and now != before:
        ways = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("near")).unionByName(pairs.select(F.col("lo").alias("node"), F.col("hi").alias("near")))
        least = ways.groupBy("node").agg(F.min(F.least("node", "near")).alias("least"))
        hung = stored(ways.join(least, "node").where("near > node").select(F.col("near").alias("hi"), F.col("least").alias("lo")).where("hi <> lo").distinct(), "pairs")
        low = hung.groupBy("hi").agg(F.min("lo").alias("least"))
        met = hung.join(low, "hi")
        pairs = met.select("hi", F.col("least").alias("lo")).unionByName(met.select(F.col("lo").alias("hi"), F.col("least").alias("lo")))
        pairs = stored(pairs.where("hi <> lo").distinct(), "pairs")
        before, now = now, _fingerprint(pairs)
    own = pairs.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(own)


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def predecessor(rows: DataFrame, keys: Sequence[str], number: str, is_new: str) -> DataFrame:
    """For each new article the greatest existing number strictly before it (an as-of lookup by one sort)."""
    order = Window.partitionBy(*keys).orderBy(sort_key(F.col(number)), F.desc(is_new), number).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("predecessor", F.last(F.when(~F.col(is_new), F.col(number)), ignorenulls=True).over(order)).where(F.col(is_new))


def principal(decrees: DataFrame) -> DataFrame:
    """The principal decree of each aiot: the flagged one (more than one is an error), else the last active
    authorisation, else the first active decree, else the first."""
    flagged = F.sum(F.col("principal").cast("int")).over(Window.partitionBy("aiot"))
    rank = F.when(F.col("principal"), 0).when(F.col("active") & (F.col("file_type") == "AP_AUTORISATION"), 1).when(F.col("active"), 2).otherwise(3)
    order = Window.partitionBy("aiot").orderBy(rank, F.when(rank == 1, F.lit(-1)).otherwise(F.lit(1)) * F.col("_place"))
    rows = decrees.withColumn("_place", F.row_number().over(Window.partitionBy("aiot").orderBy("decree_id"))).withColumn("_flagged", flagged)
    rows = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return rows.withColumn("error", F.when(F.col("_flagged") > 1, F.lit("several principal decrees"))).drop("_n", "_place", "_flagged")


def start_filter(decrees: DataFrame, start: str | None = None) -> DataFrame:
    """Decrees after the start date, by default after the first decree of their aiot (dates compare as text)."""
    least = F.coalesce(F.lit(start), F.min("decree_id").over(Window.partitionBy("aiot")))
    return decrees.withColumn("_start", least).where(F.col("decree_id") > F.col("_start")).drop("_start")


def other_decrees(decrees: DataFrame, ops: DataFrame) -> DataFrame:
    """Active decrees beside the principal one: ``modifying`` if an operation starts from them, else ``complement``."""
    sources = ops.select("aiot", F.col("source_decree").alias("decree_id")).distinct()
    rest = decrees.where("active and not principal")
    changed = rest.join(sources, ["aiot", "decree_id"], "left_semi").withColumn("role", F.lit("modifying"))
    return changed.unionByName(rest.join(sources, ["aiot", "decree_id"], "left_anti").withColumn("role", F.lit("complement")))


def range_roles(kind: Column, nth: Column) -> Column:
    """Kind of an operation on the article at a place, from 0, of its range: replacing a range replaces the first and removes the others."""
    return F.when((kind == "REPLACE") & (nth > 0), F.lit("REMOVE")).otherwise(kind)
