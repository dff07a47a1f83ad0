"""Identifiers of decrees and articles, as Column expressions.

Decree ids stay strings: they are compared as text, and dates such as
``2021-02-31`` are accepted on purpose.  A level of an article id is a number,
a Roman numeral or a single letter; ``C`` and ``D`` are the letters 3 and 4.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL = r"(?:\d+|[IVXLCDM]+|[ivxlcdm]+|[A-Za-z])"
ARTICLE = rf"^{LEVEL}(?:[.-]{LEVEL})*$"
KEYWORDS = ("ALL", "END", "APPENDIX")
NOT_SORTABLE = 999_999
SPACE = r"(?U)\s+"

#: File kinds by words in the name, longest first (fixed values).
FILE_KINDS = (
    ("ap servitude d'utilité publique", "ARRETE_PREFECTORAL"),
    ("ap prescriptions complémentaires", "AP_COMPLEMENTAIRE"),
    ("ap autorisation temporaire", "AP_AUTORISATION"),
    ("ap d'autorisation", "AP_AUTORISATION"),
    ("arrêté préfectoral", "ARRETE_PREFECTORAL"),
    ("ap enregistrement", "AP_AUTORISATION"),
)
#: Rank of a kind among decrees of one date (fixed values).
KIND_RANK = {"AP_AUTORISATION": 0, "ARRETE_PREFECTORAL": 1, "AP_COMPLEMENTAIRE": 2, "AUTRE": 3}
#: Names of documents that are no decrees (fixed values).
NOT_DECREES = (
    "rapport d'ap d'autorisation",
    "rapport",
    "document de procédure",
    "fiche seveso",
    "inspection",
    "arrêté de mise en demeure",
    "ap mise en demeure",
    "ap levée de mise en demeure",
    "ap mesures conservatoires",
    "ap mesures d'urgence",
)


def valid_article(c: Column) -> Column:
    """True for ids that need no change; prefixes and keywords are case-sensitive."""
    rest = F.regexp_replace(c, "^(?:APPENDIX|NEW_ARTICLE):", "")
    return F.coalesce(c.isin(*KEYWORDS) | rest.rlike(ARTICLE), F.lit(False))


def canonical_article(c: Column) -> Column:
    """The id in canonical form, null for free text: blanks go, keywords and prefixes become upper case."""
    flat = F.trim(F.regexp_replace(c, SPACE, " "))
    head = F.upper(F.regexp_extract(flat, r"^(?i)(appendix|new_article):", 1))
    body = F.regexp_replace(flat, r"^(?i)(?:appendix|new_article):", "")
    compact = F.regexp_replace(F.regexp_replace(body, SPACE, ""), r"^[.-]+|[.-]+$", "")
    joined = F.when(head != "", F.concat(head, F.lit(":"), compact)).otherwise(compact)
    return F.when(F.upper(flat).isin(*KEYWORDS), F.upper(flat)).when(compact.rlike(ARTICLE), joined)


def valid_decree(c: Column) -> Column:
    """Three integer parts within the ranges of a date; no calendar check."""
    y, m, d = (F.try_element_at(F.split(c, "-"), F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return F.coalesce((F.size(F.split(c, "-")) == 3) & y.between(1900, 2100) & m.between(1, 12) & d.between(1, 31), F.lit(False))


def display_number(c: Column) -> Column:
    return F.regexp_replace(c, "^NEW_ARTICLE:", "")


def sort_fragment(c: Column) -> Column:
    return F.regexp_replace(display_number(c), "^APPENDIX:", "")


def _roman(level: Column) -> Column:
    """Value of a Roman numeral: a sign before a greater one counts negative."""
    worth = F.create_map(*(F.lit(x) for pair in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in pair))
    signs = F.transform(F.split(F.upper(level), ""), lambda s: F.element_at(worth, s))
    return F.aggregate(
        F.reverse(signs),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")),
        lambda a, v: F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), F.greatest(v, a["last"]).alias("last")),
        lambda a: a["sum"],
    )


def levels(c: Column) -> Column:
    """Integers of an article number's levels, null where it has none."""
    fragment = F.trim(c)

    def one(level: Column) -> Column:
        letter = F.length(level) == 1
        return (
            F.when(level.rlike(r"^\d+$"), level.try_cast("int"))
            .when(letter & level.rlike("^[A-HJ-UWYZa-hj-uwyz]$"), F.ascii(F.upper(level)) - 64)
            .when(level.rlike("^(?:[IVXLCDM]+|[ivxlcdm]+)$"), _roman(level))
        )

    return F.when(fragment.rlike(ARTICLE), F.transform(F.split(fragment, "[.-]"), one))


def sort_key(c: Column) -> Column:
    """Array of integers that orders article ids; what has no levels comes last."""
    return F.coalesce(levels(sort_fragment(c)), F.array(F.lit(NOT_SORTABLE)))


def article_range(start: Column, end: Column) -> Column:
    """Ids from ``start`` to ``end`` of one prefix and depth; else just the two of them."""
    prefix = lambda c: F.regexp_extract(c, r"^(.*?)(\d+)$", 1)
    last = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("int")
    fits = (prefix(start) == prefix(end)) & (last(start) <= last(end))
    run = F.transform(F.sequence(last(start), last(end)), lambda i: F.concat(prefix(start), i.cast("string")))
    return F.when(F.coalesce(fits, F.lit(False)), run).otherwise(F.array_compact(F.array(start, end)))


def contiguous(before: Column, after: Column) -> Column:
    """True where ``after`` is the next article of ``before``: same parent, last level one up; or its first child."""
    a, b = levels(before), levels(after)
    same = (F.size(a) == F.size(b)) & (F.slice(a, F.lit(1), F.size(a) - 1) == F.slice(b, F.lit(1), F.size(b) - 1))
    return F.coalesce(same & (F.element_at(b, -1) == F.element_at(a, -1) + 1), F.lit(False))


def file_kind(name: Column) -> Column:
    low = F.lower(name)
    kind = F.lit("AUTRE")
    for words, label in reversed(FILE_KINDS):
        kind = F.when(F.contains(low, F.lit(words)), F.lit(label)).otherwise(kind)
    return kind


def kind_rank(kind: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in KIND_RANK.items() for x in pair)), kind), F.lit(99))


def parse_filename(name: Column) -> Column:
    """struct(decree_id, file_type, reason) of a file name; reason says why there is no decree."""
    stem = F.regexp_replace(F.split(name, "_")[0], r"\.html$", "")
    dated = F.size(F.split(name, "_")) < 2
    kind = F.when(dated, F.lit("AUTRE")).otherwise(file_kind(name))
    reason = F.when(~name.endswith(".html"), F.lit("extension")).when(~valid_decree(stem), F.lit("date"))
    return F.struct(F.when(reason.isNull(), stem).alias("decree_id"), F.when(reason.isNull(), kind).alias("file_type"), reason.alias("reason"))


def not_a_decree(name: Column) -> Column:
    low = F.lower(name)
    out = F.lit(False)
    for words in NOT_DECREES:
        out = out | F.contains(low, F.lit(words))
    return F.coalesce(out, F.lit(False))


def is_annexe(name: Column) -> Column:
    return F.coalesce(F.contains(F.lower(name), F.lit("annexe")), F.lit(False))


def node_key(decree: Column, article: Column) -> Column:
    return F.concat_ws("#", decree, article)


def node_of(key: Column) -> Column:
    parts = F.split(key, "#", 2)
    return F.struct(parts[0].alias("arrete_id"), parts[1].alias("article_id"))
