"""Operations from tagged decrees: verbs, the references and contents they go with, raw operations.

Verbs come from a table of infinitives and are found in the alinea's words: in
the passive the references stand before them, after them where an act speaks of
itself or the participle opens the alinea.  Of the references on that side those
next to the verb count, with what is joined to them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.functions.identifiers import article_range
from consolida.operators import fragments
from consolida.operators.relations import range_roles
from consolida.operators.trees import sliced

RAW = "op_tag int, place int, range_group int, source_article string, target_arrete string, start_num string, end_num string, operation_type string, direction string, keyword string, operand string"


#: Verbs of change by what they do (fixed values).
VERBS = {
    "add": ("ajouter", "compléter", "créer", "insérer"),
    "replace": ("modifier", "rédiger", "remplacer", "substituer"),
    "delete": ("abroger", "annuler", "retirer", "supprimer"),
}
#: Acts that change others by themselves; words that may part an auxiliary from its participle; that announce a place (fixed values).
ACTS = frozenset("acte arrêté article décret".split())
ADVERBS = frozenset("ainsi donc également".split())
AHEAD = frozenset("après avant".split())
ARTICLES = frozenset("l' le la les du des de".split())
PRONOUNS = frozenset("il elle ils elles".split())
#: Forms that tell how a content is worded.
WORDED = frozenset("rédigé rédigée rédigés rédigées".split())
#: Words and marks that join references of one list.
JOINTS = frozenset("à au aux d' de des du et l' la le les ou , ;".split())
_WORD = re.compile(r"[^\W\d_]+['’]?|\d+|[^\w\s]")


def _participles(infinitive: str) -> list[str]:
    return [infinitive[:-2] + end for end in ("é", "ée", "és", "ées")]


def _presents(infinitive: str) -> list[str]:
    stem = re.sub(r"é([^aeéiou]+)er$", r"è\1er", infinitive)[:-2]
    return [s + end for s in {stem, infinitive[:-2]} for end in ("e", "ent")]


_PARTICIPLES = {form: kind for kind, verbs in VERBS.items() for v in verbs for form in _participles(v)} | {f"mis{end} à jour": "replace" for end in ("", "e", "es")}
_PRESENTS = {form: kind for kind, verbs in VERBS.items() for v in verbs for form in _presents(v)}


@dataclass(frozen=True)
class Verb:
    """A verb of change: its references stand on the left (``rtl``) or on the right (``ltr``) of it."""

    kind: str
    direction: str
    keyword: str
    content: bool
    begin: int
    end: int


class _Sentence:
    """The words of an alinea, in lower case and with straight apostrophes, and where they stand."""

    def __init__(self, text: str):
        found = list(_WORD.finditer(text))
        self.text, self.spans = text, [m.span() for m in found]
        self.words = [m[0].lower().replace("’", "'") for m in found]

    def at(self, i: int) -> str:
        return self.words[i] if i < len(self.words) else ""

    def behind_joint(self, i: int) -> int | None:
        """Behind ``et``, ``ou``, a comma or a comma with either, and an auxiliary that is said again."""
        j = i + (self.at(i) == ",")
        j += self.at(j) in ("et", "ou")
        if j == i:
            return None
        return self.behind_auxiliary(j) or j

    def behind_auxiliary(self, i: int) -> int | None:
        if self.at(i) not in ("est", "sont"):
            return None
        i += 1
        while self.at(i) in ADVERBS:
            i += 1
        return i

    def forms(self, i: int, table: dict[str, str]) -> tuple[str, int] | None:
        """(kind, index behind) of one form of a table, or of several in a row; different ones replace.

        What is ``inséré et ainsi rédigé`` is inserted: the wording only announces the content.
        """
        kinds, end, at = set(), i, i
        while at is not None:
            size = next((n for n in (3, 1) if at + n <= len(self.words) and " ".join(self.words[at : at + n]) in table), 0)
            if not size or kinds and self.words[at] in WORDED:
                break
            kinds.add(table[" ".join(self.words[at : at + size])])
            end = at + size
            at = self.behind_joint(end)
        return (kinds.pop() if len(kinds) == 1 else "replace", end) if kinds else None

    def verb(self, kind: str, direction: str, content: bool, begin: int, first: int, end: int) -> Verb:
        return Verb(kind, direction, self.text[self.spans[first][0] : self.spans[end - 1][1]], content, self.spans[begin][0], self.spans[end - 1][1])

    def active(self) -> tuple[Verb, int] | None:
        """``Le présent arrêté remplace ...``: an act that speaks of itself opens the alinea."""
        i = 0
        own = self.at(0) in ("ce", "cet", "cette")
        if own or self.at(0) == "l'" or self.at(0) in ("le", "la") and self.at(1) in ("présent", "présente"):
            i = 1 if own or self.at(0) == "l'" else 2
        if not i or self.at(i) not in ACTS:
            return None
        found = self.forms(i + 1, _PRESENTS)
        if not found or self.at(found[1]) not in ARTICLES:
            return None
        kind, end = found
        listed = self.words[end : end + 3] in (["les", "articles", "suivants"], ["l'", "article", "suivant"])
        return self.verb(kind, "ltr", kind != "delete" and listed, 0, i + 1, end), end

    def passive(self, i: int) -> tuple[Verb, int] | None:
        """``est`` or ``sont`` at a place, with participles of change."""
        first = self.behind_auxiliary(i)
        found = self.forms(first, _PARTICIPLES) if first else None
        if not found or self.at(found[1]) in ("au", "aux") and self.at(found[1] + 1) in ("recueil", "recueils"):
            return None
        kind, end = found
        if kind == "replace" and self.words[end : end + 3] == ["par", "l'", "ajout"]:
            kind, end = "add", end + 3
        ahead = i == 0 and kind == "add" and (self.at(end) in AHEAD or self.words[end : end + 3] == ["à", "la", "suite"])
        return self.verb(kind, "ltr" if ahead else "rtl", kind != "delete", i, first, end), end


def verbs(text: str) -> list[Verb]:
    """The verbs of change of an alinea's text, in order.

    ``est supprimé. Il est remplacé ...`` is one change, and so is ``est inséré
    ... et est ainsi rédigé``.
    """
    sentence = _Sentence(text)
    out, i, behind = [], 0, 0
    while i < len(sentence.words):
        found = sentence.active() if i == 0 else None
        found = found or sentence.passive(i)
        if found and not (out and sentence.at(i - 1) == "et" and found[0].keyword.lower() in WORDED):
            between = sentence.words[behind:i]
            if out and out[-1].kind == "delete" and found[0].kind == "replace" and len(between) == 2 and between[0] in (".", ";") and between[1] in PRONOUNS:
                out.pop()
            out.append(found[0])
            behind = found[1]
        i = found[1] if found else i + 1
    return out


def _placed(alinea: fragments.Node) -> tuple[list[tuple[int, int, fragments.Node]], list[tuple[int, fragments.Node]]]:
    """References of an alinea with where they begin and end in its text, and quotations and tables with where they begin."""
    refs, contents, at = [], [], 0
    for n in alinea.walk():
        if n.tag is None:
            at += len(n.text)
        elif n.attrs.get("data-spec") in ("section_reference", "document_reference"):
            refs.append((at, at + len(n.string()), n))
        elif n.tag in ("q", "table"):
            contents.append((at, n))
    return refs, contents


def _nearest(refs: list[tuple[int, int, fragments.Node]], text: str, verb: Verb, begin: int, end: int) -> list[tuple[int, int, fragments.Node]]:
    """The references between two places that stand next to the verb, with those joined to them."""
    side = [r for r in refs if begin <= r[0] and r[1] <= end]
    order = side[::-1] if verb.direction == "rtl" else side
    out: list[tuple[int, int, fragments.Node]] = []
    for r in order:
        if out:
            left, right = (r, out[-1]) if verb.direction == "rtl" else (out[-1], r)
            if not set(_Sentence(text[left[1] : right[0]]).words) <= JOINTS:
                break
        out.append(r)
    return out[::-1] if verb.direction == "rtl" else out


def _content_of(alinea: fragments.Node, contents: list[tuple[int, fragments.Node]], behind: int) -> fragments.Node | None:
    """The next quotation or table in the alinea, else a table in the next one."""
    later = next((n for at, n in contents if at >= behind), None)
    if later is not None:
        return later
    row = alinea.parent.children
    for n in row[row.index(alinea) + 1 :]:
        if n.tag is None and not n.text.strip() or n.attrs.get("data-spec") in fragments.PAGINATION:
            continue
        return next(iter(n.every("table")), n if n.tag == "table" else None)
    return None


def _dated(ref: fragments.Node | None, by_id: dict[str, fragments.Node]) -> str | None:
    """The date of a reference, or of the nearest it belongs to."""
    seen = set()
    while ref is not None and id(ref) not in seen:
        if ref.attrs.get("data-date"):
            return ref.attrs["data-date"]
        seen.add(id(ref))
        ref = by_id.get(ref.attrs.get("data-parent_reference", ""))
    return None


def _operations(html: str, own_date: str) -> list[tuple]:
    root = fragments.parse(html)
    by_id = {n.attrs["data-tag_id"]: n for n in root.walk() if n.attrs.get("data-tag_id")}
    out, tag = [], 0
    for alinea in root.spec("alinea"):
        refs, contents = _placed(alinea)
        text, behind = alinea.string(), 0
        found = verbs(text) if refs else []
        for k, verb in enumerate(found):
            ahead = found[k + 1].begin if k + 1 < len(found) else len(text)
            near = _nearest(refs, text, verb, *((behind, verb.begin) if verb.direction == "rtl" else (verb.end, ahead)))
            behind = verb.end
            sections = [r for *_, r in near if r.attrs.get("data-spec") == "section_reference" and r.attrs.get("data-type") != "table"]
            documents = [r for *_, r in near if r.attrs.get("data-spec") == "document_reference"]
            parents = {r.attrs.get("data-parent_reference") for r in sections}
            leaves = [r for r in sections if r.attrs.get("data-tag_id") not in parents] or sections
            if not leaves and not documents:
                continue
            holder = alinea.parent
            while holder is not None and not (holder.attrs.get("data-spec") == "section" and holder.attrs.get("data-number")):
                holder = holder.parent
            after = max(verb.end, near[-1][1]) if verb.direction == "ltr" else verb.end
            operand = _content_of(alinea, contents, after) if verb.content else None
            inside = None if operand is None else operand.html() if operand.tag != "q" else "".join(c.html() for c in operand.children)
            fallback = documents[-1].attrs.get("data-date") if documents else own_date
            for place, ref in enumerate(leaves or documents[:1]):
                group = ref.attrs.get("data-group_id") or ""
                out.append((tag, place, int(group) if group.isdigit() else place, holder.attrs["data-number"] if holder is not None else None, _dated(ref, by_id) or fallback, ref.attrs.get("data-start_num"), ref.attrs.get("data-end_num"), verb.kind, verb.direction, verb.keyword, inside))
            tag += 1
    return out


def tag_operations(decrees: DataFrame) -> DataFrame:
    """Verbs with their references and contents: one row per reference of each operation (aiot, decree_id, ...)."""
    names = ["aiot", "decree_id", *(c.split()[0] for c in RAW.split(", "))]
    types = [pa.string(), pa.string(), *(pa.int32() if c.endswith(" int") else pa.string() for c in RAW.split(", "))]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for aiot, decree, html in sliced(batch):
                if found := [(aiot, decree, *op) for op in _operations(html or "", decree)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

    return decrees.select("aiot", "decree_id", "html").mapInArrow(expand, f"aiot string, decree_id string, {RAW}")


def raw_operations(tagged: DataFrame) -> DataFrame:
    """One raw operation per article, ranges spelled out; a replaced range replaces its first article."""
    numbers = F.when(F.col("start_num").isNull(), F.array(F.lit(None).cast("string"))).when(F.col("end_num").isNull(), F.array("start_num")).otherwise(article_range(F.col("start_num"), F.col("end_num")))
    rows = tagged.select("*", F.posexplode(numbers).alias("nth", "target_article"))
    rows = rows.withColumn("operation_type", F.upper(F.when(F.col("operation_type") == "delete", F.lit("remove")).otherwise(F.col("operation_type"))))
    rows = rows.withColumn("operation_type", range_roles(F.col("operation_type"), F.col("nth")))
    return rows.select("aiot", "decree_id", "op_tag", F.col("decree_id").alias("source_arrete"), F.coalesce("source_article", F.lit("ALL")).alias("source_article"), "target_arrete", "target_article", "operation_type", "direction", "keyword", F.when(F.col("nth") == 0, F.col("operand")).alias("operand"), F.lit(None).cast("string").alias("sub_target"), F.lit("Regex").alias("origin"), F.lit(None).cast("int").alias("confidence_score"))
