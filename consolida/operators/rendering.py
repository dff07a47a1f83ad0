"""The consolidated permit: header, decrees with their articles as they stand and their history, other decrees.

Every decree is parsed once for its outline, which gives where sections begin
and end in its text.  What changes becomes edits, rows of (start, end, text),
by joins and windows over that outline; only the last step cuts the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consolida.functions.identifiers import display_number, sort_key
from consolida.functions.texts import FULL_NAMES, error_reason, fill_template, operation_label, superfluous
from consolida.operators.relations import covered, other_decrees, predecessor, principal
from consolida.operators.trees import outline, sliced
from consolida.plans.storage import stored

DECREE = ["aiot", "decree_id"]
ARTICLE = [*DECREE, "article_id"]
#: Codes of a last operation that leave an abrogation open (fixed values).
OPEN_CODES = ("error_extracting_operand", "error_finding_subtarget", "complex_subtarget")
#: Targets that stand for a whole decree (fixed values).
WHOLE = ("ALL", "END", "APPENDIX")


def listed(rows: DataFrame, keys: list[str], order: Column, html: Column, name: str, between: str = "") -> DataFrame:
    """HTML of a group's rows in order."""
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), html.alias("h")))), lambda x: x["h"]), between).alias(name))


def text_of(*parts: str | Column) -> Column:
    """Parts one after another; a null part is empty."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts))


# Articles and their history ----------------------------------------------------------------------


def told(versions: DataFrame, ops: DataFrame) -> DataFrame:
    """Versions with the operation that made each, the reason why it is open, and whether it is the last."""
    made = ops.select("aiot", F.col("id").alias("operation_id"), "operation_type", "sub_type", "sub_description", "source_article", F.col("source_decree").alias("changed_by"))
    rows = versions.join(made, ["aiot", "operation_id"], "left")
    last = F.max("version").over(Window.partitionBy(*ARTICLE))
    return rows.withColumn("reason", error_reason(F.col("error_codes"))).withColumn("last", F.col("version") == last)


def article_states(versions: DataFrame, ops: DataFrame) -> DataFrame:
    """(aiot, decree_id, article_id, title, body, history, date_version) of the articles that operations reached."""
    rows = told(versions, ops)
    by = F.col("changed_by").isNotNull()
    origin = text_of(operation_label(F.col("operation_type")), " par l'article ", F.col("source_article"), " de l'arrêté ", F.col("changed_by"))
    open_text = text_of("Opération non résolue ", operation_label(F.col("operation_type")), " de l'article ", F.col("source_article"), " de l'arrêté ", F.col("changed_by"), " (raison : ", F.col("reason"), ")")
    is_open = by & F.col("reason").isNotNull()
    now = F.when(is_open, open_text).when(by, text_of("Version actuelle après ", origin)).otherwise(F.lit("Version actuelle de l'arrêté initial"))
    then = F.when(by, text_of("Version après ", origin)).when(F.col("version") == 0, F.lit("Version de l'arrêté initial")).otherwise(F.lit("Version précédente"))
    before = F.when(is_open, text_of("<p>", open_text, "</p>")).otherwise(text_of("<details><summary>", then, "</summary><div>", F.col("content"), "</div></details>"))
    line = F.when(F.col("last"), text_of("<p><b>", now, "</b></p>")).otherwise(before)
    place = F.when(F.col("last"), F.lit(-1)).otherwise(F.col("version"))
    history = listed(rows, ARTICLE, place, line, "lines").select(*ARTICLE, text_of('<div data-spec="section_version_history">', F.col("lines"), "</div>").alias("history"))
    open_codes = F.arrays_overlap("error_codes", F.array(*(F.lit(c) for c in OPEN_CODES)))
    whole = F.col("sub_type").isNull() | (F.col("sub_type") == "FULL_SECTION") & F.lower(F.trim("sub_description")).isin(*FULL_NAMES)
    gone = F.coalesce((F.col("operation_type") == "REMOVE") & whole & ~open_codes, F.lit(False))
    body = F.when(gone, F.lit("<p><em>Article abrogé</em></p>")).otherwise(F.coalesce("content", F.lit("")))
    state = rows.where("last and (version > 0 or operation_id is not null)")
    state = state.select(*ARTICLE, F.nullif("title", F.lit("")).alias("title"), body.alias("body"), "content", F.coalesce("changed_by", "decree_id").alias("date_version"))
    return state.join(history, ARTICLE)


def messages(ops: DataFrame, versions: DataFrame) -> DataFrame:
    """(aiot, decree_id, article_id, messages): what an article's own operations came to, in their order.

    An operation's codes are those of the first version that it made, else its own.
    """
    first = versions.where("operation_id is not null").groupBy("aiot", F.col("operation_id").alias("id")).agg(F.min_by("error_codes", "version").alias("_first"))
    rows = ops.join(first, ["aiot", "id"], "left").withColumn("_codes", F.coalesce("_first", "error_codes"))
    decree = text_of("l'arrêté ", F.col("target_decree"))
    target = F.when(F.col("target_article").isin(*WHOLE), decree).otherwise(text_of("l'article ", display_number(F.col("target_article")), " de ", decree))
    label, reason = operation_label(F.col("operation_type")), error_reason(F.col("_codes"))
    text = F.when(reason.isNull(), text_of("Opération de consolidation résolue (", label, ") dans ", target)).otherwise(
        text_of("Opération de consolidation non résolue (", label, ") dans ", target, " (raison\u00a0: ", reason, ")")
    )
    rows = rows.select("aiot", F.col("source_decree").alias("decree_id"), F.col("source_article").alias("article_id"), "seq", text_of('<div data-spec="operation_result">', text, "</div>").alias("_m"))
    return listed(rows, ARTICLE, F.col("seq"), F.col("_m"), "messages")


# Edits of a decree's text --------------------------------------------------------------------------


def relevant_sections(outlines: DataFrame) -> DataFrame:
    """Sections with ``out``: those of the main part with a superfluous title; what these hold is not there."""
    rows = outlines.where("kind = 'section'").withColumn("out", F.col("in_main") & superfluous(F.col("data_title")))
    return rows.withColumn("_in", covered(F.col("out"))).where("not _in").drop("_in")


def section_edits(sections: DataFrame, states: DataFrame, notes: DataFrame) -> DataFrame:
    """(aiot, decree_id, start, end, text): superfluous sections go, changed ones are as they stand, others are marked.

    Of several sections with one id the first takes the history and the
    messages; sections inside one that is replaced go with it.
    """
    nth = F.row_number().over(Window.partitionBy(*ARTICLE, "out").orderBy("start"))
    rows = sections.withColumn("nth", nth).join(states, ARTICLE, "left").join(notes, ARTICLE, "left")
    rows = rows.withColumn("changed", ~F.col("out") & F.col("body").isNotNull())
    rows = rows.withColumn("_in", covered(F.col("changed"))).where("not _in and (out or article_id is not null)")
    first = F.col("nth") == 1
    history, notes_html = F.when(first, F.col("history")), F.when(first, F.col("messages"))
    tag = lambda changed, date: text_of(F.col("opened"), f' data-is_modified="{changed}" data-date_version="', date, '">')
    title = F.coalesce("title", "title_html", F.lit(""))
    new = text_of(tag("true", F.col("date_version")), title, notes_html, history, F.col("body"), "</section>")
    marked = tag("false", F.col("decree_id"))
    whole = rows.where("out or changed").select(*DECREE, "start", "end", F.when(F.col("out"), F.lit("")).otherwise(new).alias("text"))
    kept = rows.where("not out and not changed")
    open_text = F.when(F.col("heading_end").isNull(), text_of(marked, notes_html)).otherwise(marked)
    opened = kept.select(*DECREE, "start", F.col("open_end").alias("end"), open_text.alias("text"))
    after = kept.where(first & F.col("heading_end").isNotNull() & F.col("messages").isNotNull()).select(*DECREE, F.col("heading_end").alias("start"), F.col("heading_end").alias("end"), F.col("messages").alias("text"))
    return whole.unionByName(opened).unionByName(after).withColumn("place", F.expr("cast(array() as array<int>)"))


def new_articles(outlines: DataFrame, sections: DataFrame, states: DataFrame) -> DataFrame:
    """Edits that put new articles behind the section with the greatest number before theirs.

    Without such a section they stand before the first one, or at the end of a
    main part without sections.  Numbers that are there already and articles
    without content are left out.
    """
    top = sections.where("top and not out and article_id is not null").select(*DECREE, F.col("article_id").alias("number"), "start", "end")
    there = top.groupBy(*DECREE, "number").agg(F.max_by("end", "start").alias("anchor"))
    first = top.groupBy(*DECREE).agg(F.min("start").alias("begin"))
    new = states.where(F.col("article_id").startswith("NEW_ARTICLE") & (F.trim(F.coalesce("content", F.lit(""))) != ""))
    new = new.withColumn("number", display_number(F.col("article_id"))).join(there.select(*DECREE, "number"), [*DECREE, "number"], "left_anti")
    both = there.select(*DECREE, "number", F.lit(False).alias("is_new")).unionByName(new.select(*DECREE, "number", F.lit(True).alias("is_new")))
    after = predecessor(both, DECREE, "number", "is_new").select(*DECREE, "number", "predecessor")
    rows = new.join(after, [*DECREE, "number"]).join(there.withColumnRenamed("number", "predecessor"), [*DECREE, "predecessor"], "left").join(first, DECREE, "left")
    rows = rows.join(outlines.where("kind = 'main'").select(*DECREE, F.col("close").alias("finish")), DECREE)
    at = F.coalesce("anchor", "begin", "finish")
    html = text_of('<section data-spec="section_version" data-number="', F.col("number"), '" data-type="article" data-is_modified="true" data-date_version="', F.col("date_version"), '">', F.col("title"), F.col("history"), F.col("body"), "</section>")
    return rows.select(*DECREE, at.alias("start"), at.alias("end"), html.alias("text"), sort_key(F.col("article_id")).alias("place"))


def _spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text with their edits, from rows of (aiot, decree_id, html, spans, edits)."""

    def one(text: str, parts: list[dict], changes: list[dict] | None) -> str:
        out = []
        for part in parts:
            at = part["start"]
            for e in changes or ():
                if part["start"] <= e["start"] and e["end"] <= part["end"]:
                    out += [text[at : e["start"]], e["text"]]
                    at = e["end"]
            out.append(text[at : part["end"]])
        return "".join(out)

    for batch in batches:
        for aiot, decree, *row in sliced(batch):
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (aiot, decree, one(*row))], names=[*DECREE, "content"])


def contents(decrees: DataFrame, outlines: DataFrame, ops: DataFrame, versions: DataFrame) -> DataFrame:
    """(aiot, decree_id, content): main part and appendix of every decree, consolidated; neither: no row."""
    sections, states = stored(relevant_sections(outlines), "sections"), stored(article_states(versions, ops), "states")
    edits = section_edits(sections, states, messages(ops, versions)).unionByName(new_articles(outlines, sections, states))
    ordered = edits.groupBy(*DECREE).agg(F.array_sort(F.collect_list(F.struct("start", "end", "place", "text"))).alias("edits"))
    spans = outlines.where("kind in ('main', 'appendix')").groupBy(*DECREE).agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("kind") == "main", 0).otherwise(1).alias("nth"), "start", "end"))).alias("spans"))
    rows = decrees.select(*DECREE, "html").join(spans, DECREE).join(ordered, DECREE, "left")
    return rows.select(*DECREE, "html", "spans", "edits").mapInArrow(_spliced, "aiot string, decree_id string, content string")


# The permit ------------------------------------------------------------------------------------


def in_force(decrees: DataFrame, ops: DataFrame) -> DataFrame:
    """Decrees with ``active`` false where an operation abrogates them."""
    gone = ops.where("abrogates").select("aiot", F.col("target_decree").alias("decree_id"), F.lit(True).alias("_gone")).distinct()
    return decrees.join(gone, DECREE, "left").withColumn("active", F.col("active") & F.col("_gone").isNull()).drop("_gone")


def header(decrees: DataFrame, outlines: DataFrame) -> DataFrame:
    """(aiot, header): title, sources, visas and grounds of all decrees in order of their ids."""
    title = outlines.where("kind = 'arrete_title'").groupBy(*DECREE).agg(F.min_by(F.struct("html", "text"), "start").alias("_t"))
    rows = decrees.join(title, DECREE, "left").withColumn("label", F.coalesce(F.nullif(F.col("_t.text"), F.lit("")), F.col("filename")))
    paragraph = F.regexp_replace("_t.html", r"(?i)(</?)h1\b", "$1p")
    named = F.coalesce(paragraph, text_of("<div>", F.col("filename"), "</div>"))
    status = F.when(F.col("active"), "active").otherwise("abroge")
    source = text_of(
        '<li data-spec="permit_source" data-date="', F.col("decree_id"), '" data-status="', status, '"><p><strong>Date arrêté :</strong> ', F.col("decree_id"),
        F.when(~F.col("active"), " (ABROGE)"), F.when(F.col("principal"), " <strong>(Arrêté principal)</strong>"),
        '</p><div data-spec="permit_source_title" aria-label="', F.col("label"), '">', named, "</div></li>",
    )
    out = listed(rows, ["aiot"], F.col("decree_id"), source, "sources")
    for kind, name, head in (("visa", "permit_visa", "Visas de l'arrêté "), ("motifs", "permit_motif", "Arrêté ")):
        found = listed(outlines.where(F.col("kind") == kind), DECREE, F.col("start"), F.col("html"), "found", "\n")
        group = text_of(f'<section data-spec="{name}_group" data-date="', F.col("decree_id"), f'"><h3>{head}', F.col("decree_id"), "</h3><p>", F.col("label"), "</p>", F.col("found"), "</section>")
        out = out.join(listed(rows.select(*DECREE, "label").join(found, DECREE), ["aiot"], F.col("decree_id"), group, name), "aiot", "left")
    html = text_of(
        '<header data-spec="header"><div data-spec="permit_title"><h1>Permis d\'Exploitation Consolidé</h1><p><strong>Code AIOT ICPE :</strong> ', F.col("aiot"),
        '</p></div><section data-spec="permit_sources"><h2>Arrêtés sources</h2><ul>', F.col("sources"),
        '</ul></section><section data-spec="permit_visa"><details><summary><h2>Visas consolidés</h2></summary>', F.col("permit_visa"),
        '</details></section><section data-spec="permit_motif"><details><summary><h2>Considérants</h2></summary>', F.col("permit_motif"), "</details></section></header>",
    )
    return out.select("aiot", html.alias("header"))


def other_parts(decrees: DataFrame, ops: DataFrame, outlines: DataFrame, bodies: DataFrame) -> DataFrame:
    """(aiot, other): the modifying decrees, then those that change nothing, each with what names it and its content."""
    rows = other_decrees(decrees, ops).join(bodies, DECREE, "left")
    for kind in ("identification", "arrete_title"):
        rows = rows.join(outlines.where(F.col("kind") == kind).groupBy(*DECREE).agg(F.min_by("html", "start").alias(kind)), DECREE, "left")
    article = text_of('<article data-spec="permit_', F.col("role"), '" data-date="', F.col("decree_id"), '">', F.col("identification"), F.col("arrete_title"), F.col("content"), "</article>")
    parts = listed(rows, ["aiot", "role"], F.col("decree_id"), article, "articles")
    names = {
        "modifying": ('<section data-spec="permit_modifying_arretes"><h2>Arrêtés préfectoraux modificatifs</h2>', 0),
        "complement": ('<section data-spec="permit_complements"><h2>Autres dispositions prévues par des arrêtés préfectoraux qui ne modifient pas l\'arrêté préfectoral d\'autorisation</h2>', 1),
    }
    is_modifying = F.col("role") == "modifying"
    html = text_of(F.when(is_modifying, names["modifying"][0]).otherwise(names["complement"][0]), F.col("articles"), "</section>")
    return listed(parts, ["aiot"], F.when(is_modifying, 0).otherwise(1), html, "other")


TEMPLATE = "<html><body>{{HEADER}}{{CONTENT}}{{OTHER}}<footer>{{GENERATED_BY}}</footer></body></html>"


def permits(decrees: DataFrame, ops: DataFrame, versions: DataFrame, template: str = TEMPLATE, generated_by: str = "") -> DataFrame:
    """(aiot, html): the consolidated permit of every aiot; null where the template lacks one of its four marks.

    ``ops`` have the codes that the replay left.  A decree without a main part
    and an appendix has no content; several principal decrees are an error of
    ``relations.principal``, and then the first of them counts.
    """
    decrees = in_force(decrees, ops)
    chosen = principal(decrees).select(*DECREE, F.lit(True).alias("principal"))
    decrees = stored(decrees.drop("principal").join(chosen, DECREE, "left").withColumn("principal", F.coalesce("principal", F.lit(False))), "decrees")
    outlines = stored(outline(decrees, *DECREE), "outlines")
    bodies = stored(contents(decrees.where("active or principal"), outlines, ops, versions), "contents")
    main = decrees.where("principal").join(bodies, DECREE, "left").select("aiot", "content")
    rows = header(decrees, outlines).join(main, "aiot", "left").join(other_parts(decrees, ops, outlines, bodies), "aiot", "left")
    values = {"HEADER": F.col("header"), "CONTENT": F.col("content"), "OTHER": F.col("other"), "GENERATED_BY": F.lit(generated_by)}
    return rows.select("aiot", fill_template(F.lit(template), values).alias("html"))
