"""Permit bodies: sections as they stand, new articles, history, messages, what is left out."""

from __future__ import annotations

import re

import pytest

from consolida.operators import rendering
from consolida.operators.trees import _Outline, outline

OPS = "aiot string, seq long, id string, source_decree string, source_article string, target_decree string, target_article string, operation_type string, sub_type string, sub_description string, error_codes array<string>, abrogates boolean"
VERSIONS = "aiot string, decree_id string, article_id string, version int, title string, content string, operation_id string, error_codes array<string>"


def section(number, inner="", title=None, spec="section"):
    named = f' data-title="{title}"' if title else ""
    return f'<section data-spec="{spec}" data-number="{number}"{named}>{inner}</section>'


def body(spark, html, versions=(), ops=(), decree="2010-01-01"):
    decrees = spark.createDataFrame([("a", decree, html)], "aiot string, decree_id string, html string")
    ops = spark.createDataFrame([("a", n, *o) for n, o in enumerate(ops)], OPS)
    versions = spark.createDataFrame([("a", *v) for v in versions], VERSIONS)
    rows = rendering.contents(decrees, outline(decrees, "aiot", "decree_id"), ops, versions).collect()
    return rows[0]["content"] if rows else None


def versions(article, *contents, decree="2010-01-01", title="<h2>T</h2>", codes=()):
    return [(decree, article, n, title, c, f"op{n}" if n or article.startswith("NEW") else None, list(codes) if n == len(contents) - 1 else []) for n, c in enumerate(contents)]


def op(name, kind="REPLACE", source="2012-01-01", article="5", target="1", part="FULL_SECTION", described="ALL", codes=(), decree="2010-01-01"):
    return (name, source, article, decree, target, kind, part, described, list(codes), False)


MAIN = "<html><main>{}</main></html>".format


def test_outline_places():
    html = MAIN('\n<section data-spec="section" data-number="1"><h2>A</h2><p>é</p>' + section("1.1", "x<br/>y") + "</section>") + '<footer data-spec="appendix">' + section("2") + "</footer>"
    rows = {(r["kind"], r.get("article_id")): r for r in _Outline(html).found}
    cut = lambda r: html[r["start"] : r["end"]]
    assert cut(rows["section", "1.1"]) == section("1.1", "x<br/>y") and not rows["section", "1.1"]["top"]
    assert cut(rows["main", None]).startswith("<main>\n") and cut(rows["main", None]).endswith("</main>")
    assert cut(rows["section", "APPENDIX:2"]) == section("2") and not rows["section", "APPENDIX:2"]["in_main"]
    assert html[: rows["section", "1"]["heading_end"]].endswith("<h2>A</h2>") and rows["section", "1"]["top"]
    open_ended = _Outline('<main><section data-spec="section" data-number="1"><p>x').found
    assert [r["end"] for r in open_ended] == [len('<main><section data-spec="section" data-number="1"><p>x')] * 2


def test_sections_that_nothing_changed_are_marked(spark):
    html = MAIN(section("1", "<p>a</p>") + "between" + section("", "no number")) + '<footer data-spec="appendix">' + section("2", "b") + "</footer>rest"
    out = body(spark, html)
    assert out == (
        '<main><section data-spec="section_version" data-number="1" data-is_modified="false" data-date_version="2010-01-01"><p>a</p></section>between<section data-spec="section" data-number="">no number</section></main>'
        '<footer data-spec="appendix"><section data-spec="section_version" data-number="2" data-is_modified="false" data-date_version="2010-01-01">b</section></footer>'
    )
    assert body(spark, "<html><p>neither</p></html>") is None


def test_superfluous_sections_go_with_what_they_hold(spark):
    html = MAIN(section("1", "kept") + section("2", "gone " + section("2.1", "gone too"), "Délais et  voies de recours") + section("3", "kept too")) + '<footer data-spec="appendix">' + section("4", "stays", "FRAIS") + "</footer>"
    out = body(spark, html, versions("2.1", "x", "never shown"), [op("op1", target="2.1")])
    assert "gone" not in out and "never shown" not in out and "kept too" in out and "stays" in out


def test_history(spark):
    out = body(spark, MAIN(section("1", "<h2>Old</h2>first") + section("1", "again")), versions("1", "first", "second", "third"), [op("op1"), op("op2", "ADD", "2013-01-01", "6")])
    history = re.search('<div data-spec="section_version_history">.*?</div></details></div>', out)[0]
    assert history == (
        '<div data-spec="section_version_history"><p><b>Version actuelle après ajout par l\'article 6 de l\'arrêté 2013-01-01</b></p><details><summary>Version de l\'arrêté initial</summary><div>first</div></details>'
        "<details><summary>Version après modification par l'article 5 de l'arrêté 2012-01-01</summary><div>second</div></details></div>"
    )
    assert out.count("section_version_history") == 1 and out.count('data-date_version="2013-01-01"') == 2
    assert out.count("third") == 2 and "again" not in out


def test_open_operations_are_told_without_their_copies(spark):
    reason = "La sous-cible de l'opération n'a pas pu être trouvée dans l'article cible"
    rows = [("2010-01-01", "1", 0, "", "v0", None, []), ("2010-01-01", "1", 1, "", "v0", "op1", ["error_finding_subtarget"]), ("2010-01-01", "1", 2, "", "v0", "op2", ["error_finding_subtarget"])]
    out = body(spark, MAIN(section("1", "<h3 data-spec='section_title'>Own</h3>v0")), rows, [op("op1"), op("op2", source="2014-01-01")])
    assert out.count("<details>") == 1
    assert f"<p>Opération non résolue modification de l'article 5 de l'arrêté 2012-01-01 (raison : {reason})</p>" in out
    assert f"<p><b>Opération non résolue modification de l'article 5 de l'arrêté 2014-01-01 (raison : {reason})</b></p>" in out
    assert "<h3 data-spec='section_title'>Own</h3><div data-spec=\"section_version_history\">" in out


@pytest.mark.parametrize(
    ("kind", "part", "described", "codes", "gone"),
    [
        ("REMOVE", None, None, [], True),
        ("REMOVE", "FULL_SECTION", "ALL", [], True),
        ("REMOVE", "FULL_SECTION", " Contenu Entier", [], True),
        ("REMOVE", "FULL_SECTION", "tOUt", [], True),
        ("REMOVE", "FULL_SECTION", "other", [], False),
        ("REMOVE", "FULL_SECTION", None, [], False),
        ("REMOVE", "TABLEAU", "ALL", [], False),
        ("REMOVE", "FULL_SECTION", "ALL", ["error_extracting_operand"], False),
        ("REMOVE", "FULL_SECTION", "ALL", ["disabled_llm_call"], True),
        ("REPLACE", "FULL_SECTION", "ALL", [], False),
        ("ADD", "FULL_SECTION", "ALL", [], False),
    ],
)
def test_abrogated(spark, kind, part, described, codes, gone):
    out = body(spark, MAIN(section("1", "text")), versions("1", "text", "rest", codes=codes), [op("op1", kind, part=part, described=described)])
    assert ("<p><em>Article abrogé</em></p></section>" in out) == gone == ("rest</section>" not in out)


def test_new_articles_stand_behind_the_number_before_them(spark):
    ops = [op("op0", "ADD", target="NEW_ARTICLE:2.1")]
    rows = [v for n in ("2.10", "2.9", "1.5", "9", "0.1", "3") for v in versions(f"NEW_ARTICLE:{n}", f"new {n}")] + versions("NEW_ARTICLE:7", "  ")
    out = body(spark, MAIN("start" + section("2", section("2.1")) + "-" + section("1") + section("3") + "end"), rows, ops)
    assert re.findall('data-number="([^"]*)"', out) == ["0.1", "2", "2.1", "2.9", "2.10", "1", "1.5", "3", "9"]
    assert '<section data-spec="section_version" data-number="9" data-type="article" data-is_modified="true" data-date_version="2012-01-01"><h2>T</h2><div data-spec="section_version_history">' in out
    alone = body(spark, MAIN("<p>text</p>"), versions("NEW_ARTICLE:2", "b") + versions("NEW_ARTICLE:1", "a"), ops)
    assert re.findall('<p>text</p>|data-number="([^"]*)"', alone) == ["", "1", "2"] and alone.endswith("</section></main>")


def test_messages_stand_behind_the_heading_of_the_first_section(spark):
    ops = [
        op("op0", source="2012-01-01", article="5", target="1"),
        op("op1", "ADD", article="5", target="NEW_ARTICLE:4"),
        op("op2", "REMOVE", article="APPENDIX:1", target="ALL", codes=["missing_arrete"]),
        op("op3", article="6", target="2", codes=["error_extracting_operand"]),
    ]
    html = MAIN(section("5", "<h2>Five</h2>x" + section("5.1", "<h3>y</h3>")) + section("5", "<h2>Again</h2>") + section("6", "no heading")) + '<footer data-spec="appendix">' + section("1", "<h4>A</h4>") + "</footer>"
    out = body(spark, html, [("2010-01-01", "1", 0, "", "", None, []), ("2010-01-01", "1", 1, "", "", "op0", ["propagated_error"]), ("2010-01-01", "1", 2, "", "", "op0", [])], ops, decree="2012-01-01")
    told = re.findall("(<[^>]*>)?<div data-spec=\"operation_result\">(.*?)</div>", out)
    assert told == [
        ("</h2>", "Opération de consolidation non résolue (modification) dans l'article 1 de l'arrêté 2010-01-01 (raison\u00a0: Une erreur sur une opération précédente empêche l'application de cette opération)"),
        ("", "Opération de consolidation résolue (ajout) dans l'article 4 de l'arrêté 2010-01-01"),
        ('<section data-spec="section_version" data-number="6" data-is_modified="false" data-date_version="2012-01-01">', "Opération de consolidation non résolue (modification) dans l'article 2 de l'arrêté 2010-01-01 (raison\u00a0: Le contenu de l'opération n'a pas pu être extrait de l'arrêté modificatif)"),
        ("</h4>", "Opération de consolidation non résolue (abrogation) dans l'arrêté 2010-01-01 (raison\u00a0: L'arrêté cible n'est pas présent dans le permis consolidé)"),
    ]


def test_a_replaced_section_takes_those_inside_it_along(spark):
    html = MAIN(section("1", "a" + section("1.1", "b" + section("1.1.1", "c"))) + section("2", section("2.1", "d")))
    rows = versions("1.1", "b", "B", title="") + [(d, a, v, t, c, o and "op2", e) for d, a, v, t, c, o, e in versions("1.1.1", "c", "C")]
    out = body(spark, html, rows, [op("op1", target="1.1"), op("op2", target="1.1.1")])
    assert "C" not in re.sub("<[^>]*>", "", out).replace("Version", "") and out.count("</section>") == 4
    assert ">a<section" in out and out.endswith('data-number="2.1" data-is_modified="false" data-date_version="2010-01-01">d</section></section></main>')


def test_permit(spark):
    """Header with titles, visas and grounds, abrogated decrees, the others in two lists."""
    first = '<header><div data-spec="arrete_title"><h1>Premier &amp; arrêté</h1></div><div data-spec="visa">V1</div><div data-spec="visa">V2</div></header>' + MAIN(section("1", "x"))
    second = '<div data-spec="identification">id</div><div data-spec="motifs">M</div>' + MAIN(section("1", "<h2>h</h2>"))
    rows = [("a", "2010-01-01", "2010-01-01.html", first, "AUTRE", True, True), ("a", "2012-01-01", "2012-01-01.html", second, "AUTRE", True, False), ("a", "2013-01-01", "c.html", MAIN("alone"), "AUTRE", True, False), ("a", "2014-01-01", "d.html", MAIN("gone"), "AUTRE", True, False), ("b", "2011-01-01", "e.html", None, "AUTRE", True, False)]
    decrees = spark.createDataFrame(rows, "aiot string, decree_id string, filename string, html string, file_type string, active boolean, principal boolean")
    ops = spark.createDataFrame([("a", 0, "op0", "2012-01-01", "1", "2014-01-01", "ALL", "REMOVE", "FULL_SECTION", "ALL", [], True)], OPS)
    got = {r["aiot"]: r["html"] for r in rendering.permits(decrees, ops, spark.createDataFrame([], VERSIONS), generated_by="model").collect()}
    a = got["a"]
    assert "<p>Premier &amp; arrêté</p>" in a and 'aria-label="Premier & arrêté"' in a
    assert '<section data-spec="permit_visa_group" data-date="2010-01-01"><h3>Visas de l\'arrêté 2010-01-01</h3><p>Premier & arrêté</p><div data-spec="visa">V1</div>\n<div data-spec="visa">V2</div></section>' in a
    assert '<h3>Arrêté 2012-01-01</h3><p>2012-01-01.html</p><div data-spec="motifs">M</div>' in a
    assert 'data-date="2014-01-01" data-status="abroge"><p><strong>Date arrêté :</strong> 2014-01-01 (ABROGE)</p>' in a and "gone" not in a
    assert '<article data-spec="permit_modifying" data-date="2012-01-01"><div data-spec="identification">id</div><main>' in a
    assert '</section><section data-spec="permit_complements"><h2>' in a and '<article data-spec="permit_complement" data-date="2013-01-01"><main>alone</main></article>' in a
    assert a.endswith("<footer>model</footer></body></html>")
    assert "Code AIOT ICPE :</strong> b" in got["b"] and "<main>" not in got["b"]
    assert rendering.permits(decrees, ops, spark.createDataFrame([], VERSIONS), "{{HEADER}}").first()["html"] is None
