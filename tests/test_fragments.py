from __future__ import annotations

import pytest

from consolida.operators import fragments as fr
from consolida.operators.tagging import _operations, verbs

TABLE = "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>"
ALINEAS = '<div data-spec="alinea">x</div><div data-spec="alinea">y</div>'


@pytest.mark.parametrize(
    ("html", "kind", "position", "operand", "want"),
    [
        (ALINEAS, "ALINEA", 2, "z", '<div data-spec="alinea">x</div><div data-spec="alinea">z</div>'),
        (ALINEAS, "ALINEA", 1, None, '<div data-spec="alinea">y</div>'),
        (ALINEAS, "ALINEA", 3, "z", None),
        (ALINEAS, "ALINEA", None, "z", None),
        (TABLE, "LIGNE_TABLEAU", -1, None, "<table><tr><td>a</td><td>b</td></tr></table>"),
        (TABLE, "COLONNE_TABLEAU", 1, None, "<table><tr><td>b</td></tr><tr><td>d</td></tr></table>"),
        ("<p>x</p>", "COLONNE_TABLEAU", 1, None, "<p>x</p>"),
        ("<p>One. Two.</p>", "PHRASE", 2, "Three", "<p>One. Three.</p>"),
        ("<p>old</p>", "FULL_SECTION", None, "<section><p>new</p></section>", "<p>new</p>"),
        ("a" + TABLE, "TABLEAU", None, "<p>t</p>", "a<p>t</p>"),
    ],
)
def test_changes(html, kind, position, operand, want):
    assert fr.change_fragment(html, kind, position, operand) == want


def test_inserts():
    assert fr.insert_fragment(ALINEAS, "ALINEA", 1, "<p>n</p>") == '<div data-spec="alinea">x</div><p>n</p><div data-spec="alinea">y</div>'
    assert fr.insert_fragment(TABLE, "COLONNE_TABLEAU", 1, "<td>n</td>").count("<td>n</td>") == 1
    assert fr.insert_fragment(ALINEAS, "ALINEA", 9, "n") is None


def test_marker_spans():
    text = "<p>The  first <b>bold</b> words</p>"
    assert fr.marker_span(text, "first") == (8, 13)
    a, b = fr.marker_span(text, "The first")
    assert text[a:b] == "The  first"
    a, b = fr.marker_span(text, "first bold")
    assert text[a:b] == "first <b>bold</b>"
    assert fr.marker_span(text, "missing") is None and fr.marker_span(text, " ") is None


def test_quotes_become_alineas():
    html = '<section data-spec="section" data-number="2"><div data-spec="alinea" data-number="1">a<blockquote><p>b</p><p>c</p></blockquote></div><div data-spec="alinea" data-number="2">d</div></section>'
    out = fr.quotes_to_alineas(html)
    assert "blockquote" not in out
    assert [n.attrs["data-number"] for n in fr.parse(out).spec("alinea")] == ["1", "2", "3", "4"]


def test_swallowed_article_opens_a_section():
    ref = '<a data-spec="section_reference" data-type="article" data-start_num="3">Article 3</a> : Noise'
    html = f'<section data-spec="section" data-number="2"><div data-spec="alinea" data-number="1">a<blockquote><p>{ref}</p><p>text</p></blockquote></div></section>'
    sections = fr.parse(fr.quotes_to_alineas(html)).spec("section")
    assert [(s.attrs["data-number"], s.attrs.get("data-title")) for s in sections] == [("2", None), ("3", "Noise")]


def test_sections_and_titles():
    html = '<main><section data-spec="section" data-number="1"><h2>T</h2><p>b</p></section><footer data-spec="appendix"><section data-spec="section" data-number="1"><p>c</p></section></footer></main>'
    assert "<p>b</p>" in fr.find_section(html, "1") and "<p>c</p>" in fr.find_section(html, "APPENDIX:1")
    assert fr.find_section(html, "9") is None
    assert fr.split_title(fr.find_section(html, "1")) == ("<h2>T</h2>", "<p>b</p>")
    assert fr.strip_heading("<h2> t </h2><p>x</p>", "<h3>T</h3>") == "<p>x</p>"


@pytest.mark.parametrize(
    ("text", "kind", "direction", "content"),
    [
        ("L'article 2 est remplacé par les dispositions suivantes :", "replace", "rtl", True),
        ("L'article 2 est abrogé.", "delete", "rtl", False),
        ("L'article 3 est complété par l'alinéa suivant", "add", "rtl", True),
        ("Sont insérés après le paragraphe 4.23, les", "add", "ltr", True),
        ("Le présent arrêté annule et remplace l'arrêté", "replace", "ltr", False),
        ("L'arrêté abroge les dispositions", "delete", "ltr", False),
    ],
)
def test_verbs(text, kind, direction, content):
    found = verbs(text)[0]
    assert (found.kind, found.direction, found.content) == (kind, direction, content)


@pytest.mark.parametrize(
    ("text", "kind", "keyword"),
    [
        ("Le tableau est modifié et complété comme suit", "replace", "modifié et complété"),
        ("Les prescriptions sont annulées et remplacées par", "replace", "annulées et remplacées"),
        ("La liste est mise à jour", "replace", "mise à jour"),
        ("Il est ainsi créé un article 4 bis", "add", "créé"),
        ("Les annexes sont supprimées", "delete", "supprimées"),
        ("Cet arrêté complète l’arrêté du 3 mai", "add", "complète"),
        ("Le présent décret modifie la liste", "replace", "modifie"),
    ],
)
def test_keywords(text, kind, keyword):
    assert [(v.kind, v.keyword) for v in verbs(text)] == [(kind, keyword)]


@pytest.mark.parametrize("text", ["L'exploitant respecte l'article 2.", "Les dispositions du présent titre remplace l'article 2", "L'avis est inséré aux recueils des actes", "est-il remplaçable ?", ""])
def test_no_verb(text):
    assert verbs(text) == []


def tagged(inner, more=""):
    return f'<main><section data-spec="section" data-number="7"><div data-spec="alinea" data-number="1">{inner}</div>{more}</section></main>'


def article(k, tag="", parent=""):
    return f'<a data-spec="section_reference" data-type="article" data-tag_id="{tag}" data-parent_reference="{parent}" data-start_num="{k}">article {k}</a>'


ACT = '<a data-spec="document_reference" data-tag_id="d" data-date="2011-02-03">arrêté du 3 février</a>'


def test_references_beside_the_verb():
    """Joined references count, one that other words part from them does not; each verb has its own."""
    html = tagged(f"Selon l'{article(1)} en vigueur, les {article(2, 'a', 'd')} et {article(3, 'b', 'd')} de l'{ACT} sont abrogés. L'{article(4)} est remplacé par : <q>x</q> puis <q>y</q>")
    got = [(o[0], o[5], o[4], o[7], o[10]) for o in _operations(html, "2020-01-01")]
    assert got == [(0, "2", "2011-02-03", "delete", None), (0, "3", "2011-02-03", "delete", None), (1, "4", "2020-01-01", "replace", "x")]


def test_content_in_the_next_alinea():
    table = "<table><tr><td>n</td></tr></table>"
    html = tagged(f"L'{article(5)} est remplacé par le tableau suivant :", f'<a data-spec="page_footer"></a><div data-spec="alinea" data-number="2">{table}</div>')
    assert [(o[3], o[5], o[10]) for o in _operations(html, "2020-01-01")] == [("7", "5", table)]
    assert _operations(tagged("Rien n'est remplacé."), "2020-01-01") == []


def test_dates_along_long_and_circular_chains():
    chain = "".join(article(k, f"t{k}", f"t{k + 1}") + ", " for k in range(1, 12)) + f'<a data-spec="document_reference" data-tag_id="t12" data-date="2012-12-12">arrêté</a>'
    assert {o[4] for o in _operations(tagged(f"L'{chain} est abrogé."), "2020-01-01")} == {"2012-12-12"}
    assert [o[4] for o in _operations(tagged(f"L'{article(1, 'x', 'x')} est abrogé."), "2020-01-01")] == ["2020-01-01"]


@pytest.mark.parametrize(
    ("text", "marker", "want"),
    [
        ("<p>flow  of\n 5 l</p>", "flow of 5 l", "flow  of\n 5 l"),
        ("<p>a < b</p>", "a &lt; b", "a < b"),
        ("<p>it's so</p>", "it&#x27;s so", "it's so"),
        ('<div><a id="r"> Part 3 </a> Scope </div>', "Part 3 Scope", '<div><a id="r"> Part 3 </a> Scope </div>'),
        ("<div> end of it </div>", "</table><div> end of it </div>", "<div> end of it </div>"),
        ("<p> a &amp;gt; b </p>", "<b>a</b> &gt; b", "<p> a &amp;gt; b </p>"),
        ('<i title="rule 3"> see rule 3 </i>', "<b>rule</b> 3", "rule 3"),
        ("<section><p> One </p></section>", "<i>One</i>", "<p> One </p>"),
        ("<section><p> A <br/> B </p></section>", "<i>A</i> B", "<p> A <br/> B </p>"),
        ("<p>RULE 3</p>", "<b>rule</b> 3", "<p>RULE 3</p>"),
        ("<p>of l’ <a> act </a> of 1 May , is</p>", "<b>of</b> l’act of 1 May, is", "<p>of l’ <a> act </a> of 1 May , is</p>"),
        ("<p>foobar</p>", "foo bar", None),
        ("<p>arrived</p>", "<b>arr</b> ived", None),
        ("<p>x</p>", "</p><p>", None),
    ],
)
def test_marker_stages(text, marker, want):
    span = fr.marker_span(text, marker)
    assert (text[slice(*span)] if span else None) == want


def test_operands_between_markers():
    section, whole = "<p>The  end</p>", "<p>Begin here</p><p>The  end</p><p>The end</p>"
    assert fr.between_markers(section, whole, "Begin", "The end") == "Begin here</p><p>The  end</p><p>The end"
    assert fr.between_markers(section, whole, "The end", None) == "The  end"
    assert fr.between_markers(None, whole, "<b>begin</b> here", None) == "<p>Begin here</p>"
    assert fr.between_markers(section, whole, "nowhere", None) is None


def test_lines_of_quotations():
    html = '<section data-spec="section" data-number="A"><div data-spec="alinea" data-number="1">x<blockquote>b<br/>c<a data-spec="page_footer"></a><table><tr><td>t</td></tr></table></blockquote>y<blockquote>z</blockquote></div><p>between</p><div data-spec="alinea" data-number="2">last</div></section>'
    out = fr.parse(fr.quotes_to_alineas(html))
    assert [(n.attrs["data-number"], n.string()) for n in out.spec("alinea")] == [("1", "x"), ("2", "b"), ("3", "c"), ("4", "t"), ("5", "y"), ("6", "z"), ("7", "last")]
    assert fr.quotes_to_alineas("<p>a<blockquote>b</blockquote></p>").replace("</p>", "") == "<p>ab"


@pytest.mark.parametrize(("before", "after", "want"), [("2", "3", True), ("2", "4", False), ("A", "B", True), ("IX", "X", True), ("1.2", "1.3", True), ("1.2", "2", False), ("2.a", "2.b", True), ("", "1", False)])
def test_contiguous_numbers(before, after, want):
    assert fr.contiguous_numbers(before, after) == want


def test_deep_trees():
    """5,000 nested elements: no limit of the call stack."""
    from consolida.operators import trees

    html = '<div data-spec="section" data-number="1">' * 5000 + "x" + "</div>" * 5000
    assert fr.parse(html).html() == html and fr.parse(html).string() == "x"
    assert len(trees._rows(html)) == 5000 and trees._rows(html)[-1][2][-1] == 4999


def test_articles_of_one_tree():
    from consolida.operators import trees

    html = '<main><section data-spec="section" data-number="1"><h2>T</h2><p>b</p></section><section data-spec="section" data-number="1"><p>c</p></section></main><footer data-spec="appendix"><section data-spec="section" data-number="1"><p>d</p></section></footer>'
    assert trees._articles(html) == [("1", 1, "<h2>T</h2>", "<p>b</p>"), ("1", 4, "<h2>T</h2>", "<p>b</p>"), ("APPENDIX:1", 7, None, "<p>d</p>")]
