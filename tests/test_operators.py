from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from consolida.operators import chunking, relations, replay, trees, validation
from consolida.plans import storage
from consolida.sources import decrees, sinks
from consolida.streaming import incremental


def test_redundancy_equals_a_sequential_rule(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(12), i, rng.choice([None, "FULL_SECTION", "ALINEA", "TABLEAU"]), rng.randrange(2), rng.choice(["ADD", "REMOVE"])) for i in range(300)]
    kept: dict = {}
    for g, i, kind, pos, t in rows:
        kept.setdefault(g, []).append((i, kind, pos, t))
    want = set()
    for ops in kept.values():
        precise = any(k not in (None, "FULL_SECTION") for _, k, _, _ in ops)
        seen = set()
        for i, k, pos, t in ops:
            full = k in (None, "FULL_SECTION")
            scope = ("full", t) if full else (k, pos, t)
            if not (full and precise) and scope not in seen:
                seen.add(scope)
                want.add(i)
    df = spark.createDataFrame(rows, "g int, seq int, sub_type string, sub_position int, operation_type string")
    assert {r["seq"] for r in relations.without_redundant(df, ("g",)).collect()} == want


def test_chunks_reset(spark):
    rng = random.Random(2)
    sizes = {k: [rng.randrange(1, 90) for _ in range(rng.randrange(1, 12))] for k in range(40)}
    df = spark.createDataFrame([(k, p, s) for k, v in sizes.items() for p, s in enumerate(v)], "k int, p int, s int")
    got = {(r["k"], r["p"]): r["chunk"] for r in chunking.chunked(df, "k", "p", "s", 100).collect()}
    for k, v in sizes.items():
        at = chunk = 0
        for p, s in enumerate(v):
            assert got[k, p] == chunk
            at += s
            if at >= 100:
                at, chunk = 0, chunk + 1


def test_fold_equals_windows_without_exemption(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.random() < 0.3, rng.random() < 0.2) for k in range(20) for i in range(15)]
    df = spark.createDataFrame(rows, "k int, i int, error boolean, clears boolean")
    closed = {(r["k"], r["i"]): r["propagated"] for r in replay.propagated(df, ["k"], ["i"], "error", "clears").collect()}
    bad: dict = {}
    for k, i, error, clears in rows:
        blocked = bad.get(k, False) and not clears
        assert closed[k, i] == blocked
        bad[k] = error or blocked


OPS = "aiot string, seq long, id string, source_decree string, source_article string, target_decree string, target_article string, operation_type string, operand string, sub_type string, sub_position int, error_codes array<string>"


def ops_of(spark, *rows):
    return spark.createDataFrame([("a", i, f"op{i}", *r, []) for i, r in enumerate(rows)], OPS)


def articles(spark):
    return spark.createDataFrame([("a", "2010-01-01", "1", 0, "<h2>One</h2>", "<p>one</p>"), ("a", "2010-01-01", "2", 1, None, "<p>two</p>"), ("a", "2012-01-01", "1", 0, None, "x")], "aiot string, decree_id string, article_id string, pos int, title string, content string")


def known(spark):
    return spark.createDataFrame([("a", "2010-01-01", True), ("a", "2012-01-01", False)], "aiot string, decree_id string, principal boolean")


def test_replay_versions_and_propagation(spark):
    ops = ops_of(
        spark,
        ("2012-01-01", "1", "2010-01-01", "1", "REPLACE", None, "FULL_SECTION", None),
        ("2012-01-01", "1", "2010-01-01", "1", "ADD", "<p>more</p>", "FULL_SECTION", None),
        ("2013-01-01", "ALL", "2010-01-01", "1", "REPLACE", "<p>new</p>", "FULL_SECTION", None),
        ("2013-01-01", "ALL", "2010-01-01", "2", "REPLACE", "<p>t</p>", "TABLEAU", None),
        ("2013-01-01", "ALL", "2010-01-01", "NEW_ARTICLE:3", "ADD", "<p>three</p>", "FULL_SECTION", None),
    )
    classified = relations.classify(ops, known(spark), articles(spark))
    versions = replay.replay(classified, articles(spark))
    by = {}
    for r in versions.orderBy("version").collect():
        by.setdefault((r["decree_id"], r["article_id"]), []).append((r["operation_id"], r["content"], list(r["error_codes"])))
    assert [x[2] for x in by["2010-01-01", "1"]] == [[], ["error_extracting_operand"], ["propagated_error"], []]
    assert by["2010-01-01", "1"][-1][1] == "<p>new</p>" or by["2010-01-01", "1"][-1][1] == "new"
    assert by["2010-01-01", "2"][-1][2] == ["error_finding_subtarget"]
    assert by["2010-01-01", "NEW_ARTICLE:3"] == [("op4", "<p>three</p>", [])]
    codes = {r["id"]: list(r["error_codes"]) for r in replay.written_back(classified, versions).collect()}
    assert codes["op1"] == ["propagated_error"] and codes["op2"] == []


def test_cycles_end(spark):
    ops = ops_of(
        spark,
        ("2010-01-01", "1", "2010-01-01", "2", "REPLACE", "<p>a</p>", "FULL_SECTION", None),
        ("2010-01-01", "2", "2010-01-01", "1", "REPLACE", "<p>b</p>", "FULL_SECTION", None),
    )
    versions = replay.replay(relations.classify(ops, known(spark), articles(spark)), articles(spark))
    assert versions.count() < 12
    assert versions.where(F.array_contains("error_codes", "cycle")).count() > 0


@pytest.mark.parametrize(
    ("rows", "codes"),
    [
        ([("2012-01-01", "1", "2010-01-01", "ALL", "REMOVE", None, None, None)], ["error_extracting_target"]),
        ([("2010-01-01", "1", "2012-01-01", "ALL", "REMOVE", None, None, None)], []),
        ([("2010-01-01", "1", "1999-01-01", "ALL", "REMOVE", None, None, None)], ["missing_arrete"]),
        ([("2010-01-01", "1", "2012-01-01", "ALL", "REMOVE", None, None, None), ("2010-01-01", "1", "2012-01-01", "1", "ADD", "x", None, None)], ["less_important"]),
        ([("2012-01-01", "1", "2010-01-01", "7", "ADD", "x", None, None)], ["error_extracting_target"]),
    ],
)
def test_conflicts(spark, rows, codes):
    done = relations.classify(ops_of(spark, *rows), known(spark), articles(spark))
    assert list(done.where("id = 'op0'").first()["error_codes"]) == codes


def test_decrees_of_a_date(spark):
    rows = [("a", "2020-01-01_b.html", "AUTRE"), ("a", "2020-01-01_AP d'autorisation.html", "AP_AUTORISATION"), ("a", "2020-01-01_annexe.html", "AUTRE"), ("a", "2020-01-01_rapport.html", "AUTRE")]
    df = spark.createDataFrame([(a, f, "2020-01-01", k, f) for a, f, k in rows], "aiot string, filename string, decree_id string, file_type string, html string")
    got = relations.one_decree_a_date(df).collect()
    assert [(r["filename"], r["html"]) for r in got] == [("2020-01-01_AP d'autorisation.html", "2020-01-01_AP d'autorisation.html")]  # an annexe without a main part is left out
    assert [(r["filename"], r["identical"]) for r in relations.decree_duplicates(df).collect()] == [("2020-01-01_b.html", False)]


@pytest.mark.parametrize(
    ("base", "want"),
    [
        ('<body><main>b</main><footer data-spec="appendix">f</footer></body>', '<body><main>b</main><footer data-spec="appendix">f<p>1</p><p>2</p></footer></body>'),
        ("<body><main>b</main>x</body>", '<body><main>b</main><footer data-spec="appendix"><p>1</p><p>2</p></footer>x</body>'),
        ("<body>b</BODY>\n", '<body>b<footer data-spec="appendix"><p>1</p><p>2</p></footer></BODY>\n'),
        ("b", 'b<footer data-spec="appendix"><p>1</p><p>2</p></footer>'),
    ],
)
def test_annexes_join_the_appendix(spark, base, want):
    rows = [("2020-01-01.html", base), ("2020-01-01_annexe 2.html", "<main><p>2</p></main>"), ("2020-01-01_annexe 1.html", "x<main><p>1</p></main>y"), ("2020-01-01_annexe 3.html", "no main")]
    df = spark.createDataFrame([("a", f, "2020-01-01", "AUTRE", h) for f, h in rows], "aiot string, filename string, decree_id string, file_type string, html string")
    assert [r["html"] for r in relations.one_decree_a_date(df).collect()] == [want]
    alone = relations.one_decree_a_date(df.where("filename like '%annexe%'")).collect()
    assert [r["html"] for r in alone] == ["x<main><p>1</p></main><footer data-spec=\"appendix\"><p>2</p></footer>y"]


def test_numbers_of_keys_that_span_partitions(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    got = relations.numbered(df, ["k"], ["v"], "n").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for k in ("hot", "a", None):
        assert [r["n"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["v"])] == list(range(1, 1 + sum(x == k for x, _ in rows)))


def test_merged_operations(spark):
    columns = "aiot string, seq long, id string, source_decree string, source_article string, target_decree string, target_article string, operation_type string, sub_type string, sub_position int"
    first = spark.createDataFrame([("a", 7, "x", "d", "1", "t", "1", "ADD", "FULL_SECTION", None), ("a", 9, "y", "d", "2", "t", "1", "ADD", "FULL_SECTION", None)], columns)
    then = spark.createDataFrame([("a", 1, "x", "d", "3", "t", "1", "ADD", "ALINEA", 1), ("a", 2, "x_2", "d", "4", "t", "1", "ADD", None, None), ("a", 3, "z", "d", "1", "t", "1", "REPLACE", "ALINEA", 2), ("a", 4, "w", "d", "2", "t", "1", "ADD", "FULL_SECTION", None), ("b", 1, "x", "d", "3", "t", "1", "ADD", "ALINEA", 1)], columns)
    got = {(r["aiot"], r["source_article"], r["operation_type"]): (r["seq"], r["id"]) for r in relations.merged(first, then).collect()}
    assert got == {("a", "2", "ADD"): (2, "y"), ("a", "3", "ADD"): (3, "x"), ("a", "4", "ADD"): (4, "x_2"), ("a", "1", "REPLACE"): (5, "z"), ("b", "3", "ADD"): (1, "x")}
    again = relations.merged(then.where("id = 'x' and aiot = 'a'"), then.where("id <> 'x'").unionByName(first.where("id = 'x'").withColumn("source_article", F.lit("9"))))
    assert sorted(r["id"] for r in again.where("aiot = 'a'").collect()) == ["w", "x", "x_2", "x_2_2", "z"]


def test_files_and_operations_round_trip(spark, tmp_path):
    folder = tmp_path / "in" / "0001"
    folder.mkdir(parents=True)
    body = '<html><body data-arretify_version="0.2.3"><section data-spec="section" data-number="1"><p>x</p></section></body></html>'
    (folder / "2020-01-01.html").write_text(body)
    (folder / "2020-02-01_ap enregistrement.html").write_text(body.replace("0.2.3", "1.0"))
    found = decrees.decrees(decrees.html_files(spark, str(tmp_path / "in")))
    assert {(r["filename"], r["reject_reason"]) for r in found.collect()} == {("2020-01-01.html", None), ("2020-02-01_ap enregistrement.html", "version")}
    assert decrees.load_decrees(spark, str(tmp_path / "in")).count() == 1
    with pytest.raises(decrees.EmptyFolder):
        (tmp_path / "none").mkdir()
        decrees.html_files(spark, str(tmp_path / "none"))
    ops = ops_of(spark, ("2012-01-01", "1", "2010-01-01", "ALL", "ADD", "<blockquote>q</blockquote>", None, None)).withColumn("origin", F.lit("Regex")).withColumn("sub_description", F.lit(None).cast("string")).withColumn("confidence_score", F.lit(80))
    text = sinks.operation_json(ops).first()["value"]
    assert "error_codes" not in text and "sub_target" not in text
    (folder / "operations.json").write_text(f"[{text}]")
    back = decrees.operations(spark, str(tmp_path / "in")).first()
    assert (back["operand"], back["target_article"], list(back["error_codes"])) == ("q", "ALL", ["not_an_operation"])


def test_strict_json(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ('{"b": 1}',), ("[1]",)], "j string")
    got = [r["reject_reason"] for r in decrees.strict_json(rows, "j", "a int", ["a"]).collect()]
    assert got == [None, "type", "unknown field", "no object"]


def test_scores_of_files(spark, tmp_path):
    """Operations found and true ones from their files: appendices and new articles count by their numbers, copies as often as they are there."""
    from consolida.operators import evaluation

    def file(folder, site, *ops):
        (tmp_path / folder / site).mkdir(parents=True)
        rows = [{"id": f"o{n}", "operation_type": kind, "source_id": {"arrete_id": s, "article_id": a}, "target_id": {"arrete_id": t, "article_id": b}, "error_codes": ["less_important"]} for n, (s, a, t, b, kind) in enumerate(ops)]
        (tmp_path / folder / site / "operations.json").write_text(json.dumps(rows))

    one, two = ("2012-01-01", "3", "2010-01-01", "1.2", "REPLACE"), ("2012-01-01", "APPENDIX:2", "2010-01-01", "NEW_ARTICLE:4", "ADD")
    file("found", "1", one, one, two, ("2012-01-01", "5", "2010-01-01", "1", "REMOVE"))
    file("found", "2", ("2012-01-01", "2", "2010-01-01", "4", "ADD"))
    file("truth", "1", one, ("2012-01-01", "2", "2010-01-01", "4", "ADD"), ("2012-01-01", "9", "2010-01-01", "9", "AUTRE"))
    file("truth", "2", one, two)
    detected, truth = decrees.operations(spark, str(tmp_path / "found")), decrees.ground_truth(spark, str(tmp_path / "truth"))
    keys = ["source_decree", "source_number", "target_decree", "target_number", "operation_type"]
    got = {r["aiot"]: (r["tp"], r["fp"], r["fn"]) for r in evaluation.scores(evaluation.operation_key(detected), evaluation.operation_key(truth), "aiot", keys).collect()}
    assert got == {"1": (2, 2, 0), "2": (1, 0, 1), "TOTAL": (3, 2, 1)}


def test_histories_round_trip(spark, tmp_path):
    from consolida.sources import site_files

    columns = "aiot string, decree_id string, article_id string, version int, title string, content string, operation_id string, error_codes array<string>"
    rows = [("a", "2010-01-01", "1.10", 0, "<h2>\"T\"</h2>", "é\n", None, []), ("a", "2010-01-01", "1.10", 1, None, "x", "op1", ["b", "a"]), ("a", "2010-01-01", "APPENDIX:2", 0, "", "", None, []), ("b", "2011-01-01", "1", 0, "", "y", None, [])]
    versions = spark.createDataFrame(rows, columns)
    site_files.write(sinks.history_file(versions, versions), str(tmp_path))
    assert list(json.loads((tmp_path / "a" / "history.json").read_text())) == ["2010-01-01#1.10", "2010-01-01#APPENDIX:2"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "history.json").write_text("no object")
    back = sorted(map(tuple, decrees.histories(spark, str(tmp_path)).collect()), key=str)
    assert back == sorted(((*r[:-1], sorted(r[-1])) for r in rows), key=str)


def test_confidence(spark):
    rows = spark.createDataFrame([(1, None), (1, 10), (1, 70), (2, 90)], "k int, confidence_score int")
    got = sorted((r["k"], r["confidence_score"] or 0, r["had_low"]) for r in validation.by_confidence(rows, 70, "k").collect())
    assert got == [(1, 0, True), (1, 70, True), (2, 90, False)]


def test_stream_numbers_versions(spark, tmp_path):
    schema = "target string, operation_id string, ts long, error boolean, clears boolean"
    rows = [("t", "a", 1, True, False), ("t", "b", 2, False, False), ("t", "c", 3, False, True), ("u", "d", 1, False, False)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.numbered(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("numbered").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = sorted(tuple(r) for r in spark.table("numbered").collect())
    assert got == [("t", "a", 1, False), ("t", "b", 2, True), ("t", "c", 3, False), ("u", "d", 1, False)]


def test_results_do_not_depend_on_partitions(spark):
    ops = ops_of(spark, *[("2012-01-01", "1", "2010-01-01", str(1 + i % 2), "ADD", f"<p>{i}</p>", "FULL_SECTION", None) for i in range(6)])
    seen = []
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(str, replay.replay(relations.classify(ops, known(spark), articles(spark)), articles(spark)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_downstream_has_no_last_step(spark):
    """A chain of more than 200 links is followed to its end, and a cycle at it ends."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(205)] + [(205, 203)], "src long, dst long").coalesce(1)
    found = relations.downstream(edges, spark.createDataFrame([(0,)], "node long").coalesce(1))
    assert {(r["node"], r["steps"]) for r in found.collect()} == {(i, i) for i in range(206)}


def test_reached_nodes_are_not_shuffled_again(spark, monkeypatch):
    """Chains longer than the tables that are merged, a cycle and a fork; what is stored in buckets is joined where it is."""
    monkeypatch.setattr(relations, "MERGED", 2)
    chain = [(i, i + 1) for i in range(7)] + [(7, 3), (1, 5), (4, 4)]
    edges = spark.createDataFrame(chain, "src long, dst long")
    got = {(r["seed"], r["node"]): r["steps"] for r in relations.downstream(edges, spark.createDataFrame([(0,), (6,), (0,), (99,)], "node long")).collect()}
    want = {}
    for seed in (0, 6, 99):
        at, step = {seed}, 0
        while at:
            want |= {(seed, n): step for n in at}
            at, step = {d for s, d in chain if s in at} - {n for s, n in want if s == seed}, step + 1
    assert got == want
    pairs = spark.range(100).selectExpr("id AS seed", "id * 2 AS node")
    held = storage.bucketed(pairs, "reached", "seed", "node")
    plan = pairs.repartition("node").join(held.hint("merge"), ["seed", "node"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(seed") == 1


def test_redundancy_sorts_once(spark):
    """A task holds the rows of one sort, for both windows."""
    ops = spark.createDataFrame([("a", "b", 1, "ADD", "ALINEA", 0)], "source string, target string, seq int, operation_type string, sub_type string, sub_position int")
    plan = relations.without_redundant(ops, ("source", "target"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_batches_become_objects_in_slices():
    """Of a batch of documents only a few at a time are Python objects."""
    import pyarrow as pa

    seen = []

    class Batch:
        num_rows = 200

        def slice(self, at, n):
            seen.append((at, n))
            return pa.RecordBatch.from_pydict({"html": ["x"] * min(n, 200 - at)})

    rows = trees.sliced(Batch())
    assert next(rows) == ("x",) and seen == [(0, trees.SLICE)]
    assert len(list(rows)) == 199 and len(seen) == -(-200 // trees.SLICE)
