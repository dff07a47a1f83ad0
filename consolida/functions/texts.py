"""Text, JSON and phrase functions, as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"(?U)\s+"
_PLAIN = {c: unicodedata.normalize("NFD", c)[0] for c in map(chr, range(0xC0, 0x250)) if unicodedata.normalize("NFD", c)[0] < "\x80"}

#: Section titles that a consolidated permit leaves out (fixed values).
SUPERFLUOUS = (
    "MODIFICATIONS ET COMPLÉMENTS APPORTÉS AUX PRESCRIPTIONS DES ACTES ANTÉRIEURS",
    "MODALITÉS D'EXÉCUTION",
    "MODALITÉ D'EXÉCUTION, VOIES DE RECOURS",
    "FRAIS",
    "SANCTIONS",
    "DIFFUSION",
    "PUBLICATION",
    "PUBLICATION ET AMPLIATION",
    "AMPLIATION",
    "PUBLICITÉ",
    "MESURES DE PUBLICITÉ",
    "PUBLICITÉ ET EXÉCUTION",
    "INFORMATION DES TIERS",
    "TRANSMISSION À L'EXPLOITANT",
    "EXÉCUTION",
    "DÉLAIS",
    "DÉLAIS DE RÉALISATION",
    "ÉCHÉANCES",
    "ÉCHÉANCES ET DURÉE",
    "RECOURS",
    "DÉLAI ET VOIE DE RECOURS",
    "DÉLAIS ET VOIES DE RECOURS",
    "DÉLAIS ET VOIES DE RECOURS-PUBLICITÉ-EXÉCUTION",
    "DÉLAIS ET VOIES DE RECOURS - PUBLICITÉ - EXECUTION",
)
#: Severity of error codes and their messages (fixed values).
LOW_CODES = ("not_an_operation", "less_important", "missing_arrete")
MESSAGES = {
    "error_extracting_operand": "Le contenu de l'opération n'a pas pu être extrait de l'arrêté modificatif",
    "error_extracting_target": "L'article cible de l'opération n'a pas pu être extrait de l'arrêté concerné",
    "error_extracting_source": "L'article source de l'opération n'a pas pu être extrait de l'arrêté concerné",
    "error_finding_subtarget": "La sous-cible de l'opération n'a pas pu être trouvée dans l'article cible",
    "complex_subtarget": "La sous-cible de l'opération est trop complexe pour être résolue automatiquement",
    "propagated_error": "Une erreur sur une opération précédente empêche l'application de cette opération",
    "disabled_llm_call": "La résolution des opérations complexes par IA est désactivée",
    "not_an_operation": "Il n'y a pas d'opération de consolidation à réaliser",
    "less_important": "L'arrêté présente d'autres opérations qui rendent celle-ci caduque",
    "missing_arrete": "L'arrêté cible n'est pas présent dans le permis consolidé",
}
DEFAULT_MESSAGE = "Opération non résolue automatiquement"
FULL_NAMES = ("contenu entier", "all", "tout")
#: Ordinals and elements of sub-targets (fixed values), in the order in which they are tried.
ORDINALS = (
    ("premier", 1),
    ("premi[eè]re", 1),
    ("1er", 1),
    ("1[eè]re", 1),
    ("deuxi[eè]me", 2),
    ("2[eè]me", 2),
    ("troisi[eè]me", 3),
    ("3[eè]me", 3),
    ("quatri[eè]me", 4),
    ("4[eè]me", 4),
    ("cinqui[eè]me", 5),
    ("5[eè]me", 5),
    ("sixi[eè]me", 6),
    ("6[eè]me", 6),
    ("septi[eè]me", 7),
    ("7[eè]me", 7),
    ("huiti[eè]me", 8),
    ("8[eè]me", 8),
    ("neuvi[eè]me", 9),
    ("9[eè]me", 9),
    ("dixi[eè]me", 10),
    ("10[eè]me", 10),
    ("dernier", -1),
    ("dernier[eè]", -1),
)
ELEMENTS = (
    (r"phrase", "PHRASE"),
    (r"alin[ée]a", "ALINEA"),
    (r"ligne\s+(?:du\s+)?tableau", "LIGNE_TABLEAU"),
    (r"colonne(?:\s+du\s+tableau)?", "COLONNE_TABLEAU"),
)


def strip_accents(c: Column) -> Column:
    """Letters with marks become plain ones, what is not ASCII then goes (ligatures and typographic signs too)."""
    return F.regexp_replace(F.translate(c, "".join(_PLAIN), "".join(_PLAIN.values())), r"[^\x00-\x7F]", "")


@F.pandas_udf(T.StringType())
def strip_accents_full(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The same for texts in decomposed form and scripts beyond Latin."""
    for s in batches:
        yield s.map(lambda t: None if t is None else unicodedata.normalize("NFD", t).encode("ascii", "ignore").decode())


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def section_title(c: Column) -> Column:
    return F.lower(squeeze(strip_accents(c)))


def superfluous(title: Column) -> Column:
    plain = [" ".join(unicodedata.normalize("NFD", t).encode("ascii", "ignore").decode().split()).lower() for t in SUPERFLUOUS]
    return F.coalesce(section_title(title).isin(*plain), F.lit(False))


def minify(html: Column) -> Column:
    """Scripts and styles go, blanks between tags go, runs of blanks become one."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?U)>\s+<", "><"), r"(?U)\s{2,}", " ")


def checksum(html: Column) -> Column:
    return F.md5(html)


def strip_page_separators(html: Column) -> Column:
    return F.regexp_replace(html, r"""(?is)<a\b[^>]*\bdata-spec\s*=\s*(["'])page_separator\1[^>]*>\s*</a>""", "")


def strip_blockquotes(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)</?blockquote\b[^>]*>", "")


def subtarget(c: Column) -> Column:
    """struct(type, position, description) of a sub-target phrase.

    A table named anywhere wins; else the first ordinal in the order of
    ``ORDINALS`` that stands before an element; what no pattern fits is COMPLEX.
    """
    low = F.lower(F.trim(c))
    part = lambda kind, n: F.struct(F.lit(99).alias("rank"), F.lit(kind).alias("type"), F.lit(n).cast("int").alias("position"))
    pairs = rf"(?iU)\b(?:{'|'.join(o for o, _ in ORDINALS)})\b\s+\b(?:{'|'.join(e for e, _ in ELEMENTS)})\b"
    ranks = F.create_map(*(x for i, (o, n) in enumerate(ORDINALS) for x in (F.lit(o.replace("[eè]", "e")), F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")))))

    def ranked(found: Column) -> Column:
        plain = F.translate(found, "èé", "ee")
        ordinal = F.element_at(ranks, F.regexp_substr(plain, F.lit(r"^\w+")))
        which = F.coalesce(*(F.when(F.contains(plain, F.lit(e.replace("[ée]", "e")[:5])), F.lit(k)) for k, (e, _) in enumerate(ELEMENTS)))
        kinds = F.array(*(F.lit(label) for _, label in ELEMENTS))
        return F.struct((ordinal["i"] * len(ELEMENTS) + which).alias("rank"), F.get(kinds, which).alias("type"), ordinal["n"].alias("position"))

    best = F.array_min(F.transform(F.regexp_extract_all(low, F.lit(pairs), F.lit(0)), ranked))
    found = F.when(low.rlike(r"(?iU)\ble\s+tableau\b"), part("TABLEAU", None)).otherwise(F.coalesce(best, part("COMPLEX", None)))
    blank = c.isNull() | (F.trim(F.regexp_replace(c, SPACE, " ")) == "")
    whole = F.when(blank | low.isin(*FULL_NAMES), part("FULL_SECTION", None)).otherwise(found)
    return F.struct(whole["type"].alias("type"), whole["position"].alias("position"), F.when(blank, F.lit("ALL")).otherwise(c).alias("description"))


def error_reason(codes: Column) -> Column:
    """Messages of a set of codes in the order of the codes; null without any."""
    known = F.create_map(*(F.lit(x) for pair in MESSAGES.items() for x in pair))
    text = F.array_join(F.transform(F.array_sort(F.array_distinct(codes)), lambda c: F.coalesce(F.try_element_at(known, c), F.lit(DEFAULT_MESSAGE))), " ; ")
    return F.when(F.size(codes) > 0, text)


def low_severity(codes: Column) -> Column:
    return F.coalesce((F.size(codes) > 0) & F.forall(codes, lambda c: c.isin(*LOW_CODES)), F.lit(False))


def operation_label(kind: Column) -> Column:
    return F.when(kind == "REPLACE", F.lit("modification")).when(kind == "REMOVE", F.lit("abrogation")).otherwise(F.lit("ajout"))


def json_list(text: Column, element: str) -> Column:
    """The array between the first ``[`` and the last ``]`` of a reply; an empty one where it is no JSON."""
    found = F.from_json(F.regexp_extract(text, r"(?s)\[.*\]", 0), f"array<{element}>")
    return F.coalesce(found, F.expr(f"cast(array() as array<{element}>)"))


def fenced_html(text: Column) -> Column:
    """What a code fence of a reply holds, or else the reply."""
    return trimmed(F.coalesce(F.nullif(F.regexp_extract(text, r"(?s)```(?:html)?\s*\n?(.*?)```", 1), F.lit("")), text))


def marker_span(text: Column, marker: Column) -> Column:
    """struct(start, end) of a marker as it stands, or with blanks between its words free; null if it is not there."""
    at = F.instr(text, marker)
    words = F.regexp_replace(F.regexp_replace(F.trim(marker), r"([\\.\[\]{}()*+?^$|#-])", r"\\$1"), SPACE, r"\\s+")
    loose = F.regexp_substr(text, F.concat(F.lit("(?U)"), words))
    exact = F.struct((at - 1).alias("start"), (at - 1 + F.length(marker)).alias("end"))
    free = F.struct((F.instr(text, loose) - 1).alias("start"), (F.instr(text, loose) - 1 + F.length(loose)).alias("end"))
    return F.when(F.trim(marker) == "", F.lit(None)).when(at > 0, exact).when(loose.isNotNull(), free)


def images_out(html: Column) -> Column:
    """struct(html, images): every image becomes ``IMG_001`` and so on; the map keeps sources of those that have one."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<img\b[^>]*>"), F.lit(0))
    gaps = F.split(html, r"(?is)<img\b[^>]*>", -1)
    name = lambda i: F.format_string("IMG_%03d", i + 1)
    text = F.array_join(F.transform(gaps, lambda g, i: F.when(i < F.size(gaps) - 1, F.concat(g, name(i))).otherwise(g)), "")

    def source(tag: Column) -> Column:
        plain = F.regexp_extract(tag, r"""(?i)[\s"'](?<!-)src\s*=\s*["']([^"']*)""", 1)
        return F.coalesce(F.nullif(plain, F.lit("")), F.nullif(F.regexp_extract(tag, r"""(?i)data-src\s*=\s*["']([^"']*)""", 1), F.lit("")))

    named = F.filter(F.transform(tags, lambda t, i: F.struct(name(i).alias("key"), source(t).alias("value"))), lambda e: e["value"].isNotNull())
    return F.struct(F.when(F.size(tags) > 0, text).otherwise(html).alias("html"), F.map_from_entries(named).alias("images"))


def images_in(html: Column, images: Column) -> Column:
    """Image names back to image elements."""
    put = lambda h, e: F.replace(h, e["key"], F.concat(F.lit('<img src="'), e["value"], F.lit('"/>')))
    return F.aggregate(F.coalesce(F.map_entries(images), F.expr("cast(array() as array<struct<key:string,value:string>>)")), html, put)


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Every ``{{name}}`` replaced; null where the template lacks one of them."""
    out, ready = template, F.lit(True)
    for name, value in values.items():
        ready = ready & F.contains(template, F.lit("{{" + name + "}}"))
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(value, F.lit("")))
    return F.when(ready, out)
