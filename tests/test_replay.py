"""Replay: chains, ladders, cycles, abrogated decrees, failures, and changes that wait for a model."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from consolida.operators import relations, replay
from consolida.operators.replay import Component
from consolida.sources.model_calls import CallFailed, CallSettings

OPS = "aiot string, seq long, id string, source_decree string, source_article string, target_decree string, target_article string, operation_type string, operand string, sub_type string, sub_position int, sub_description string, error_codes array<string>, source_content string, abrogates boolean"
ARTICLES = "aiot string, decree_id string, article_id string, pos int, title string, content string"


def op(seq, source, target, kind="REPLACE", operand="new", part="FULL_SECTION", position=None, described=None, codes=(), abrogates=False, site="a"):
    return (site, seq, f"op{seq}", *source, *target, kind, operand, part, position, described, list(codes), None, abrogates)


def replayed(spark, ops, articles=(), **more):
    table = spark.createDataFrame(list(ops), OPS)
    return replay.run(table, spark.createDataFrame([("a", d, a, n, t, c) for n, (d, a, t, c) in enumerate(articles)], ARTICLES), **more)


def histories(done):
    out = {}
    for r in done.versions.orderBy("version").collect():
        out.setdefault((r["decree_id"], r["article_id"]), []).append((r["content"], r["operation_id"], list(r["error_codes"])))
    return out


def fold(edges, articles=()):
    """The same without Spark, for shapes that are too large to collect."""
    names = OPS.replace(" array<string>", "").replace(" long", "").replace(" string", "").replace(" int", "").replace(" boolean", "").split(", ")
    rows = [{**dict(zip(names, e, strict=True)), "from_gone": False} for e in edges]
    component = Component(rows, [{"decree_id": d, "article_id": a, "title": t, "content": c} for d, a, t, c in articles], {}, False)
    component.run()
    return component


def test_a_chain_carries_new_contents_down(spark):
    """The third decree changes the second's article, whose change of the first is made again with the new text."""
    a, b, c = ("2005-11-08", "1"), ("2012-09-03", "3"), ("2025-02-24", "2")
    ops = [op(0, b, a, operand="from b"), op(1, c, b, operand="from c")]
    got = histories(replayed(spark, ops, [(*a, "", "first a"), (*b, "", "first b"), (*c, "", "first c")]))
    assert [x[0] for x in got[a]] == ["first a", "from b", "from c"]
    assert [x[0] for x in got[b]] == ["first b", "from c"]
    assert [x[0] for x in got[c]] == ["first c"]


def test_long_chains():
    """5,000 articles of one decree in a row, and 600 decrees that each change their forerunner."""
    begin = time.process_time()
    row = fold([op(k, ("2010-01-01", f"{k + 1}"), ("2010-01-01", f"{k}"), operand=f"text {k}") for k in range(5000)])
    assert len(row.history) == 5000 and {len(v) for v in row.history.values()} == {2}
    assert row.history["2010-01-01", "0"][-1].content == "text 0"  # an article without versions yet takes the operation's own content
    decrees = [f"{1900 + k // 12}-{k % 12 + 1:02d}-01" for k in range(600)]
    chain = fold([op(k, (decrees[k + 1], "1"), (decrees[k], "1"), operand=f"text {k}") for k in range(599)])
    assert [v.content for v in chain.history[decrees[0], "1"]] == ["", *(f"text {k}" for k in range(599))]
    assert time.process_time() - begin < 60


def test_a_ladder_does_not_double():
    """30 layers of two articles, each changed by both of the next layer: every operation once a pass."""
    name = lambda k, s: (f"20{k + 10}-01-01", s)
    edges = [op(8 * k + 2 * i + j, name(k + 1, s), name(k, t), operand=f"{k}{s}{t}") for k in range(30) for i, s in enumerate("12") for j, t in enumerate("12")]
    ladder = fold(edges)
    assert len(ladder.history[name(0, "1")]) == 1 + 2 * 30
    assert sum(map(len, ladder.history.values())) == 60 + sum(4 * (k + 1) for k in range(30))


def test_a_component_is_an_article_where_sources_do_not_change(spark):
    edges = spark.createDataFrame([("s", "x"), ("s", "y"), ("t", "y"), ("y", "z"), ("u", "w")], "_source string, _target string")
    got = {(r["_target"], r["component"]) for r in replay.components(edges).collect()}
    assert got == {("x", "x"), ("y", "y"), ("z", "y"), ("w", "w")}


def test_connected(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(90)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def least(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = least(a), least(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in relations.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: least(x) for a, b in edges if a != b for x in (a, b)}
    assert relations.connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("gone", "codes"), [(("2009", "2012"), []), (("2012",), ["propagated_error"]), ((), ["propagated_error"])])
def test_errors_of_abrogated_decrees_do_not_stand_in_the_way(spark, gone, codes):
    target = ("2008-01-01", "1")
    ops = [op(0, ("2009-01-01", "1"), target, operand="x", part="PHRASE", position=1, codes=["error_extracting_operand"]), op(1, ("2012-01-01", "1"), target, part="PHRASE", position=1), op(2, ("2020-01-01", "1"), target, operand="Z", part="PHRASE", position=1)]
    decrees = spark.createDataFrame([("a", f"{y}-01-01", y not in gone) for y in ("2008", "2009", "2012", "2020")], "aiot string, decree_id string, active boolean")
    last = histories(replayed(spark, ops, [(*target, "", "one. two.")], decrees=decrees))[target][-1]
    assert last[2] == codes and last[0] == ("one. two." if codes else "Z. two." if gone == ("2012",) else last[0])


def test_own_codes_are_kept_whole(spark):
    ops = [op(0, ("2012-01-01", "1"), ("2010-01-01", "1"), codes=["error_extracting_source", "error_extracting_target"])]
    assert histories(replayed(spark, ops))["2010-01-01", "1"] == [("", None, []), ("", "op0", ["error_extracting_source", "error_extracting_target"])]


def test_an_operation_that_fails_makes_no_version(spark, monkeypatch):
    ops = [op(0, ("2012-01-01", "1"), ("2010-01-01", "1"), part=None), op(1, ("2013-01-01", "1"), ("2010-01-01", "1"), operand="ok")]
    done = replayed(spark, ops, [("2010-01-01", "1", "", "first")])
    assert [x[0] for x in histories(done)["2010-01-01", "1"]] == ["first", "ok"]
    assert [(r["id"], list(r["error_codes"])) for r in done.skipped.collect()] == [("op0", ["error_finding_subtarget"])]
    table = spark.createDataFrame(ops, OPS)
    codes = {r["id"]: list(r["error_codes"]) for r in replay.written_back(table, done.versions, done.skipped).collect()}
    assert codes == {"op0": ["error_finding_subtarget"], "op1": []}
    import consolida.operators.replay as module

    monkeypatch.setattr(module, "change_fragment", lambda *a: 1 / 0)
    broken = fold(ops)
    assert broken.skipped["op1"][0].startswith("ZeroDivisionError") and len(broken.history["2010-01-01", "1"]) == 1


def test_a_new_article_begins_with_its_operation(spark):
    ops = [op(0, ("2012-01-01", "1"), ("2010-01-01", "NEW_ARTICLE:3"), kind="ADD", operand='<section data-number="3"><h2>Third</h2><p>x</p></section>', part=None), op(1, ("2013-01-01", "1"), ("2010-01-01", "NEW_ARTICLE:3"), operand="y")]
    done = replayed(spark, ops)
    rows = done.versions.orderBy("version").collect()
    assert [(r["version"], r["title"], r["content"], r["operation_id"]) for r in rows] == [(0, "<h2>Third</h2>", "<p>x</p>", "op0"), (1, "<h2>Third</h2>", "y", "op1")]


def test_a_repeated_title_goes(spark):
    operand = '<section data-number="1"><h3>ARTICLE  one</h3><p>new</p></section>'
    ops = [op(0, ("2012-01-01", "1"), ("2010-01-01", "1"), operand=operand), op(1, ("2012-01-01", "1"), ("2010-01-01", "2"), operand=operand)]
    got = histories(replayed(spark, ops, [("2010-01-01", "1", "<h2>Article One</h2>", "<p>old</p>"), ("2010-01-01", "2", "<h2>Article One</h2>", "")]))
    assert got["2010-01-01", "1"][-1][0] in ("new", "<p>new</p>")
    assert "ARTICLE  one" in got["2010-01-01", "2"][-1][0]


def test_statuses_are_those_of_the_last_application(spark):
    """An operation applied again after its source changed has the codes of the last time."""
    a, b, c = ("2005-01-01", "1"), ("2012-01-01", "3"), ("2025-01-01", "2")
    ops = [op(0, b, a, operand="<table/>", part="TABLEAU"), op(1, c, b, operand="from c"), op(2, ("2020-01-01", "1"), a, operand="<div><table><tr><td>1</td></tr></table></div>")]
    done = replayed(spark, ops, [(*a, "", "no table"), (*b, "", "b")])
    codes = [x[2] for x in histories(done)[a]]
    assert codes == [[], ["error_finding_subtarget"], [], []]
    assert {r["id"]: list(r["error_codes"]) for r in replay.written_back(spark.createDataFrame(ops, OPS), done.versions).collect()} == {"op0": [], "op1": [], "op2": []}


def test_changes_that_a_model_places(spark):
    """Two changes of one article wait for one another; another article's are asked in the same round; one call fails."""

    def asked_of(model, prompt):
        if "no answer" in prompt:
            raise CallFailed(400)
        target = prompt.partition("<target>\n")[2].partition("\n</target>")[0]
        part, content = (prompt.partition(f"<{n}>\n")[2].partition(f"\n</{n}>")[0] for n in ("part", "content"))
        return f"Here it is:\n```html\n{target}[{part}={content}]\n```"

    a, b, c = ("2010-01-01", "1"), ("2010-01-01", "2"), ("2010-01-01", "3")
    ops = [
        op(0, ("2011-01-01", "1"), a, operand="x", part="COMPLEX", described="here"),
        op(1, ("2012-01-01", "1"), a, kind="REMOVE", operand=None, part="COMPLEX", described="there"),
        op(2, ("2012-01-01", "2"), b, kind="ADD", operand="y", part="COMPLEX", described="end"),
        op(3, ("2012-01-01", "3"), c, operand="z", part="COMPLEX", described="no answer"),
        op(4, ("2013-01-01", "3"), c, operand="w", part="COMPLEX", described="s", codes=["error_extracting_source"]),
    ]
    articles = [(*a, "", "A"), (*b, "", "B"), (*c, "", "C")]
    done = replayed(spark, ops, articles, call=asked_of, settings=CallSettings(min_interval=0.0))
    got = histories(done)
    assert [x[0] for x in got[a]] == ["A", "A[here=x]", "A[here=x][there=]"]
    assert [x[0] for x in got[b]] == ["B", "B[end=y]"]
    assert [x[0] for x in got[c]] == ["C", "C"] and got[c][-1][2] == ["error_extracting_source"]
    assert [(r["id"], r["reason"]) for r in done.skipped.collect()] == [("op3", "RuntimeError: the model gave no reply")]
    silent = histories(replayed(spark, ops, articles))
    assert silent[a][1][2] == ["disabled_llm_call"] and silent[a][2][2] == ["propagated_error"]


def test_no_operations(spark):
    done = replayed(spark, [], [("2010-01-01", "1", "t", "c")])
    assert [(r["version"], r["content"]) for r in done.versions.collect()] == [(0, "c")] and done.skipped.count() == 0
    assert replayed(spark, [op(0, ("2012-01-01", "1"), ("2010-01-01", "ALL"), kind="REMOVE", operand=None)]).versions.count() == 0


def test_versions_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    ops = [op(k, (f"20{rng.randrange(10, 30)}-01-01", str(rng.randrange(4))), (f"20{rng.randrange(10, 30)}-01-01", str(rng.randrange(4))), kind=rng.choice(["ADD", "REPLACE"]), operand=f"<p>{k}</p>") for k in range(60)]
    seen = []
    for parts in (1, 5):
        done = replay.run(spark.createDataFrame(ops, OPS).repartition(parts), spark.createDataFrame([], ARTICLES))
        seen.append(sorted(map(str, done.versions.withColumn("n", F.size("error_codes")).collect())))
    assert seen[0] == seen[1] and "cycle" in str(seen[0])
