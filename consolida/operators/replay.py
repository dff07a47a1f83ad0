"""Versions of articles: numbering, error propagation and chronological replay."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consolida.functions.texts import fenced_html
from consolida.operators.fragments import append_body, change_fragment, insert_fragment, split_title, without_title
from consolida.operators.relations import connected
from consolida.operators.trees import sliced
from consolida.plans.storage import stored
from consolida.sources.model_calls import CallSettings, change_prompt, with_replies


def version_numbers(ops: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Version 1, 2, ... of each operation on its article (version 0 is the article as it was)."""
    return ops.withColumn("version", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest(versions: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return versions.groupBy(*keys).agg(F.max_by(F.struct("version", *columns), "version").alias("v")).select(*keys, "v.*")


def propagated(ops: DataFrame, keys: Sequence[str], order: Sequence[str], error: str, clears: str) -> DataFrame:
    """``propagated``: an earlier error since the last clearing operation stands in the way.

    Gaps and islands in two windows; for own errors that do not depend on the content.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = ops.withColumn("_island", F.sum(F.col(clears).cast("int")).over(w))
    inside = Window.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max(F.col(error).cast("int")).over(inside), F.lit(0)) == 1
    return rows.withColumn("propagated", before & ~F.col(clears)).drop("_island")


def blocked(steps: DataFrame, key: str, order: Sequence[str], error: str, clears: str, exempt: str) -> DataFrame:
    """``steps`` with ``blocked``: propagation with the abrogation exemption.

    Trailing errors that all come from abrogated decrees do not stand in the
    way.  The steps of a key pass one after another, sorted by Spark, so a key
    with any number of them takes no more memory than a batch.
    """
    rows = steps.repartition(key).sortWithinPartitions(key, *order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bad, only = object(), False, True
        for batch in batches:
            out = []
            for k, own, clear, free in zip(*(batch.column(c).to_pylist() for c in (key, error, clears, exempt)), strict=True):
                if k != now:
                    now, bad, only = k, False, True
                stop = bad and not only and not clear
                only = (only or not bad) and bool(free) if own or stop else True
                bad = bool(own) or stop
                out.append(stop)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.bool_())], names=[*batch.schema.names, "blocked"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in steps.schema)
    return rows.mapInArrow(fold, f"{ddl}, blocked boolean")


VERSIONS = "aiot string, decree_id string, article_id string, version int, title string, content string, operation_id string, error_codes array<string>"
OWN = {"error_extracting_operand", "error_extracting_target", "not_an_operation"}
#: Codes of operations that never reach an article.
UNAPPLIED = ("not_an_operation", "missing_arrete", "less_important")
PARTS = frozenset(("FULL_SECTION", "PHRASE", "ALINEA", "TABLEAU", "LIGNE_TABLEAU", "COLONNE_TABLEAU"))

_VERSION = [c.split()[0] for c in VERSIONS.split(", ")]
#: What the fold gives: versions, operations that made none, prompts that wait for a reply.
_FOLDED = f"component string, kind string, {VERSIONS}, note string"
_FOLDED_SCHEMA = pa.schema(
    [("component", pa.string()), ("kind", pa.string()), ("aiot", pa.string()), ("decree_id", pa.string()), ("article_id", pa.string()), ("version", pa.int32())]
    + [(c, pa.string()) for c in ("title", "content", "operation_id")]
    + [("error_codes", pa.list_(pa.string())), ("note", pa.string())]
)


class _Waits(Exception):
    """A change that needs a reply which is not there yet; carries the prompt."""


class _NoPart(Exception):
    """A change without a sub-target."""


class _Version:
    __slots__ = ("codes", "content", "operation", "title")

    def __init__(self, title: str | None, content: str, operation: str | None = None, codes: Sequence[str] = ()):
        self.title, self.content, self.operation, self.codes = title, content, operation, sorted(codes)


class Component:
    """The articles that operations connect, and their versions.

    Decrees come in order of their dates.  A decree's pass has its operations
    and those further down that start in an article they change: each once,
    when all of the pass that leads to its source is done, and with the new
    content of its source if that changed.  What leads back to an article whose
    operations are done already ends with the code ``cycle``.
    """

    def __init__(self, ops: list[dict], articles: list[dict], replies: dict[str, str | None], ask: bool):
        self.replies, self.ask = replies, ask
        self.first = {(a["decree_id"], a["article_id"]): (a["title"], a["content"]) for a in articles}
        self.history: dict[tuple, list[_Version]] = {}
        self.trail: dict[tuple, bool | None] = {}  # whether all errors at the end come from abrogated decrees; None without any
        self.out: dict[tuple, list[dict]] = {}
        self.skipped: dict[str, tuple[str, list[str]]] = {}
        self.prompts: set[str] = set()
        self.blocked: set[tuple] = set()
        for o in sorted(ops, key=lambda o: o["seq"]):
            o["source"], o["target"] = (o["source_decree"], o["source_article"]), (o["target_decree"], o["target_article"])
            o["codes"] = list(o["error_codes"] or ())
            self.out.setdefault(o["source"], []).append(o)
        for edges in self.out.values():
            edges.sort(key=lambda o: (o["target"], o["seq"]))

    def run(self) -> None:
        by_decree: dict[str, list[tuple]] = {}
        for node in sorted(self.out):
            by_decree.setdefault(node[0], []).append(node)
        for decree in sorted(by_decree):
            self._pass(by_decree[decree])

    def _pass(self, sources: list[tuple]) -> None:
        waiting: dict[tuple, int] = {}
        left, ahead = set(sources), list(sources)
        while ahead:
            for o in self.out[ahead.pop()]:
                t = o["target"]
                waiting[t] = waiting.get(t, 0) + 1
                if t in self.out and t not in left:
                    left.add(t)
                    ahead.append(t)
        touched: set[tuple] = set()
        begun: set[tuple] = set()
        for node in [n for n in sources if n not in waiting]:
            self._walk(node, waiting, touched, begun)
        while left := left - begun:  # these stand in or behind a cycle: one of its articles goes first
            self._walk(min(left, key=lambda n: (n not in touched, n)), waiting, touched, begun)

    def _walk(self, node: tuple, waiting: dict[tuple, int], touched: set[tuple], begun: set[tuple]) -> None:
        """The operations of an article and of all that this makes ready, depth first."""
        begun.add(node)
        stack = [iter(self.out[node])]
        while stack:
            o = next(stack[-1], None)
            if o is None:
                stack.pop()
                continue
            t = o["target"]
            followed = self._apply(o, o["source"] in touched, t in begun)
            touched.add(t)
            waiting[t] -= 1
            if not waiting[t] and t in self.out and t not in begun:
                begun.add(t)
                if followed:
                    stack.append(iter(self.out[t]))

    def _apply(self, o: dict, chained: bool, again: bool) -> bool:
        """Adds a version to the target; False where its own operations do not follow."""
        t, past = o["target"], self.history.get(o["target"])
        if o["source"] in self.blocked or t in self.blocked:
            self.blocked.add(t)
            return True
        operand = o["operand"]
        if chained and past and operand is not None and o["source"] in self.history:
            operand = self.history[o["source"]][-1].content
        fresh = o["operation_type"] == "ADD" and t[1].startswith("NEW_ARTICLE") and o["sub_type"] in (None, "FULL_SECTION")
        if past is None:
            title, content = self.first.get(t, (None, None))
            past = [_Version(title, content or "")]
            if not fresh:
                self.history[t] = past
        last = past[-1]
        try:
            if again:
                codes, content = ["cycle"], last.content
            elif last.codes and not _clears(o) and self.trail.get(t) is not True:
                codes, content = ["propagated_error"], last.content
            else:
                codes, content = self._changed(o, operand, last, fresh)
        except _Waits as wanted:
            self.prompts.add(str(wanted))
            self.blocked.add(t)
            return True
        except Exception as problem:  # of one operation: it makes no version
            self.skipped[o["id"]] = (f"{type(problem).__name__}: {problem}", ["error_finding_subtarget"] if isinstance(problem, _NoPart) else o["codes"])
            return False
        exempt = self.trail.get(t) is not False and bool(o["from_gone"])
        self.trail[t] = exempt if codes else None
        if fresh and not again:
            title, body = split_title(content)
            self.history[t] = [_Version(title, body, o["id"], codes)]
            return False
        past.append(_Version(last.title, content, o["id"], codes))
        return True

    def _changed(self, o: dict, operand: str | None, last: _Version, fresh: bool) -> tuple[list[str], str]:
        """Codes and new content of one operation."""
        kind, part, content = o["operation_type"], o["sub_type"], last.content
        if OWN.intersection(o["codes"]):
            return o["codes"], content
        if kind != "REMOVE" and operand is None:
            return ["error_extracting_operand"], content
        if fresh:
            return [], operand
        if part is None:
            raise _NoPart("no sub-target")
        if kind == "REPLACE":
            operand = without_title(operand, o["target_article"].removeprefix("NEW_ARTICLE:"), last.title)
        if part not in PARTS:
            return self._asked(o, operand if kind != "REMOVE" else None, content)
        if kind == "ADD" and part == "FULL_SECTION":
            return [], append_body(content, operand)
        if kind == "ADD":
            done = insert_fragment(content, part, o["sub_position"], operand)
        else:
            done = change_fragment(content, part, o["sub_position"], operand if kind == "REPLACE" else None)
        return (["error_finding_subtarget"], content) if done is None else ([], done)

    def _asked(self, o: dict, operand: str | None, content: str) -> tuple[list[str], str]:
        """A change that only a model can place: its reply, or the wait for it."""
        if not self.ask:
            return ["disabled_llm_call"], content
        if "error_extracting_source" in o["codes"]:
            return ["error_extracting_source"], content
        prompt = change_prompt(o["operation_type"], o["target_article"], content, o["sub_description"], operand, o["source_content"])
        key = hashlib.sha256(prompt.encode()).hexdigest()
        if key not in self.replies:
            raise _Waits(prompt)
        if self.replies[key] is None:
            raise RuntimeError("the model gave no reply")
        return [], self.replies[key] or content

    def rows(self, component: str, aiot: str) -> Iterator[tuple]:
        """Versions and skipped operations; of a component that waits, its prompts alone."""
        if self.prompts:
            for prompt in sorted(self.prompts):
                yield component, "prompt", aiot, None, None, None, None, None, None, [], prompt
            return
        for (decree, article), versions in self.history.items():
            for n, v in enumerate(versions):
                yield component, "version", aiot, decree, article, n, v.title, v.content, v.operation, v.codes, None
        for operation, (reason, codes) in self.skipped.items():
            yield component, "skipped", aiot, None, None, None, None, None, operation, codes, reason


def _clears(op: dict) -> bool:
    return "not_an_operation" in op["codes"] or op["operation_type"] != "ADD" and op["sub_type"] == "FULL_SECTION"


def _folded(batches: Iterator[pa.RecordBatch], ask: bool) -> Iterator[pa.RecordBatch]:
    """Components one after another, from rows sorted by component."""

    def done(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        by_kind = {kind: [r for r in rows if r["kind"] == kind] for kind in ("article", "op", "reply")}
        fold = Component(by_kind["op"], by_kind["article"], {r["id"]: r["content"] for r in by_kind["reply"]}, ask)
        fold.run()
        found = fold.rows(rows[0]["component"], rows[0]["aiot"])
        while some := list(itertools.islice(found, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), _FOLDED_SCHEMA, strict=True)], schema=_FOLDED_SCHEMA)

    now: list[dict] = []
    for batch in batches:
        for cells in sliced(batch):
            row = dict(zip(batch.schema.names, cells, strict=True))
            if now and row["component"] != now[0]["component"]:
                yield from done(now)
                now = []
            now.append(row)
    if now:
        yield from done(now)


@dataclass
class Replayed:
    """``versions`` of every article; ``skipped``: aiot, id, error_codes, reason of operations that made none."""

    versions: DataFrame
    skipped: DataFrame


def _node(decree: str, article: str) -> Column:
    return F.concat_ws("\u0001", "aiot", decree, article)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` with the ``component`` of their target.

    An article that nothing changes has no state, so it connects none of the
    articles that it changes: most components are one article.
    """
    changed = edges.select(F.col("_target").alias("_changed")).distinct()
    moving = edges.join(changed, F.col("_source") == F.col("_changed"), "left_semi").select(F.col("_source").alias("a"), F.col("_target").alias("b"))
    found = connected(moving).select(F.col("id").alias("_id"), F.col("component").alias("_component"))
    return edges.join(found, F.col("_target") == F.col("_id"), "left").withColumn("component", F.coalesce("_component", "_target")).drop("_id", "_component")


def run(ops: DataFrame, articles: DataFrame, decrees: DataFrame | None = None, call: Callable[[str, str], str] | None = None, settings: CallSettings | None = None) -> Replayed:
    """Replays all operations, component by component.

    ``ops`` as from ``relations.classify`` with ``articles`` (aiot, decree_id,
    article_id, pos, title, content; of equal ids the first counts); ``decrees``
    tells which are out of force from the start.  With ``call``, changes that
    no rule can place are asked of a model: components that need replies wait,
    their prompts are sent once each, and they are folded again with the
    replies, until none waits.  Rows: aiot ... as in ``VERSIONS``.
    """
    spark = ops.sparkSession
    have = lambda c, kind="string": F.col(c).cast(kind) if c in ops.columns else F.lit(None).cast(kind)
    gone = ops.where("abrogates").select("aiot", F.col("target_decree").alias("source_decree"))
    if decrees is not None:
        gone = gone.unionByName(decrees.where("not active").select("aiot", F.col("decree_id").alias("source_decree")))
    applied = ops.where(~F.arrays_overlap("error_codes", F.array(*(F.lit(c) for c in UNAPPLIED))) & (F.col("target_article") != "ALL"))
    rows = applied.join(gone.distinct().withColumn("_gone", F.lit(True)), ["aiot", "source_decree"], "left")
    rows = rows.select(
        "aiot", "seq", "id", "source_decree", "source_article", "target_decree", "target_article", "operation_type", "operand", "sub_type", F.col("sub_position").cast("int").alias("sub_position"),
        have("sub_description").alias("sub_description"), have("source_content").alias("source_content"), "error_codes", F.coalesce("_gone", F.lit(False)).alias("from_gone"),
        _node("source_decree", "source_article").alias("_source"), _node("target_decree", "target_article").alias("_target"),
    )
    edges = stored(components(stored(rows, "edges")).drop("_source"), "edges")
    first = articles.groupBy("aiot", "decree_id", "article_id").agg(F.min_by(F.struct("title", "content"), "pos").alias("_a")).select("aiot", "decree_id", "article_id", "_a.*")
    first = stored(first.withColumn("_target", _node("decree_id", "article_id")), "articles")
    of = edges.select("_target", "component").distinct()
    known = first.join(of, "_target").drop("_target").withColumn("kind", F.lit("article"))
    columns = ["kind", "component", "aiot", "decree_id", "article_id", "title", "content", *edges.drop("_target", "component", "aiot").columns]
    both = known.unionByName(edges.drop("_target").withColumn("kind", F.lit("op")), allowMissingColumns=True).select(columns)
    wanted, found, asked = both, [], None
    while True:
        streams = wanted.repartition("component").sortWithinPartitions("component", "kind", "seq")
        folded = stored(streams.mapInArrow(lambda it: _folded(it, call is not None), _FOLDED), "versions")
        found.append(folded.where("kind <> 'prompt'"))
        prompts = folded.where("kind = 'prompt'").select("component", "aiot", "note", F.sha2("note", 256).alias("id"))
        if call is None or prompts.isEmpty():
            break
        fresh = prompts.select("id", "note").distinct()
        replies = stored(with_replies(fresh, "note", call, settings).select("id", fenced_html(F.col("reply")).alias("content")), "replies")
        asked = replies if asked is None else asked.unionByName(replies)
        waits = prompts.select("component").distinct()
        own = prompts.select("component", "aiot", "id").unionByName(wanted.where("kind = 'reply'").select("component", "aiot", "id")).distinct()
        more = own.join(asked, "id").withColumn("kind", F.lit("reply"))
        wanted = both.join(waits, "component", "left_semi").unionByName(more, allowMissingColumns=True).select(columns)
        wanted = stored(wanted, "waiting")
    rows = functools.reduce(DataFrame.unionByName, found)
    versions = rows.where("kind = 'version'").select(_VERSION)
    still = first.join(of.select("_target").distinct(), "_target", "left_anti").select("aiot", "decree_id", "article_id", F.lit(0).alias("version"), "title", "content", F.lit(None).cast("string").alias("operation_id"), F.expr("cast(array() as array<string>)").alias("error_codes"))
    skipped = rows.where("kind = 'skipped'").select("aiot", F.col("operation_id").alias("id"), "error_codes", F.col("note").alias("reason"))
    return Replayed(versions.unionByName(still), skipped)


def replay(ops: DataFrame, articles: DataFrame, decrees: DataFrame | None = None) -> DataFrame:
    """Version history of every article, without a model."""
    return run(ops, articles, decrees).versions


def written_back(ops: DataFrame, versions: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Operations with the codes of the last version they made, or with which they were skipped; the others keep theirs."""
    made = versions.where("operation_id is not null").groupBy("aiot", F.col("operation_id").alias("id")).agg(F.max_by("error_codes", "version").alias("_codes"))
    if skipped is not None:
        late = skipped.select("aiot", "id", F.col("error_codes").alias("_codes"))
        made = made.unionByName(late.join(made, ["aiot", "id"], "left_anti"))
    return ops.join(made, ["aiot", "id"], "left").withColumn("error_codes", F.coalesce("_codes", "error_codes")).drop("_codes")
