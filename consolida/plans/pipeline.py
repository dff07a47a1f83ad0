"""The whole consolidation: decrees and operations to versions, statuses and permits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.operators import detection, evaluation, relations, rendering, replay, tagging, trees, validation
from consolida.plans.storage import stored
from consolida.sources.model_calls import CallSettings


@dataclass
class Consolidation:
    operations: DataFrame
    versions: DataFrame
    permits: DataFrame | None
    usage: DataFrame | None = None


def tagged_operations(decrees: DataFrame) -> DataFrame:
    """Operations that the verb grammar finds in tagged decrees."""
    rows = validation.tagged(tagging.raw_operations(tagging.tag_operations(decrees)))
    rows = relations.numbered(rows, ["aiot"], ["decree_id", "op_tag", "target_article"], "seq")
    rows = rows.withColumn("id", F.concat(F.lit("tag_op_"), "seq"))
    return validation.from_raw(rows).where("reject_reason is null").drop("reject_reason").where(validation.characterised())


def detected_operations(found: detection.Detected) -> DataFrame:
    """Operations that a model found, numbered by decree, chunk and place."""
    rows = relations.numbered(found.operations, ["aiot"], ["decree_id", "chunk_index", "place"], "seq")
    rows = validation.from_raw(rows.withColumn("id", F.concat(F.lit("op_"), "seq")))
    return rows.where("reject_reason is null").drop("reject_reason")


def chosen(decrees: DataFrame, include: Sequence[str] | None = None, principal_id: str | None = None) -> DataFrame:
    """The decrees to work on; ``principal_id`` names the principal ones."""
    rows = detection.included(decrees, include)
    return rows if principal_id is None else rows.withColumn("principal", F.col("decree_id") == principal_id)


@dataclass
class Found:
    """Operations of decrees before they are classified: all, and what the model's calls took."""

    operations: DataFrame
    usage: DataFrame | None


def find(
    decrees: DataFrame,
    call: Callable[[str, str], str] | None = None,
    settings: CallSettings | None = None,
    candidates: DataFrame | None = None,
    start: str | None = None,
    tagging_ops: bool = True,
    threshold: int | None = 70,
    retry: bool = False,
    counts: dict[str, int] | None = None,
) -> Found:
    """Operations that the grammar finds, with those of a model or given ones.

    Given ``candidates`` take the place of the model's; without either there are
    the grammar's alone, and with either those only with ``tagging_ops``.
    """
    counts = {} if counts is None else counts
    usage = None
    if candidates is None and call is not None:
        found = detection.of_decrees(decrees, call, settings, start, threshold, retry)
        usage = found.usage
        counts["rejected"] = found.rejected.count()
        candidates = detected_operations(found)
    if candidates is None:
        return Found(stored(tagged_operations(decrees), "tagged", counts), usage)
    candidates = stored(candidates, "candidates", counts)
    if not tagging_ops:
        return Found(candidates, usage)
    tagged = stored(tagged_operations(decrees), "tagged", counts)
    return Found(relations.merged(tagged, candidates.select(*(c for c in candidates.columns if c in tagged.columns))), usage)


def run(
    decrees: DataFrame,
    call: Callable[[str, str], str] | None = None,
    settings: CallSettings | None = None,
    candidates: DataFrame | None = None,
    start: str | None = None,
    tagging_ops: bool = True,
    threshold: int | None = 70,
    retry: bool = False,
    render: bool = True,
    template: str = rendering.TEMPLATE,
    generated_by: str = "",
    counts: dict[str, int] | None = None,
) -> Consolidation:
    """From decrees to permits; ``counts`` takes the rows of every stage."""
    counts = {} if counts is None else counts
    rows = stored(decrees, "decrees", counts)
    found = find(rows, call, settings, candidates, start, tagging_ops, threshold, retry, counts)
    done = consolidate(rows, found.operations, call, settings, render, template, generated_by, counts)
    done.usage = found.usage
    return done


def evaluate(
    decrees: DataFrame,
    truth: DataFrame,
    rates: DataFrame,
    call: Callable[[str, str], str] | None = None,
    settings: CallSettings | None = None,
    candidates: DataFrame | None = None,
    tagging_ops: bool = False,
    threshold: int | None = 70,
    retry: bool = False,
) -> DataFrame:
    """The score sheet of the operations that ``find`` gives, for the aiots with ground truth.

    Seconds are those that the calls took: all sites run in one job.
    """
    rows = stored(decrees.join(truth.select("aiot").distinct(), "aiot", "left_semi"), "decrees")
    found = find(rows, call, settings, candidates, None, tagging_ops, threshold, retry)
    ops = stored(found.operations, "detected")
    articles = stored(trees.articles(rows, "aiot", "decree_id"), "articles")
    classified = stored(relations.classify(ops, rows.select("aiot", "decree_id", "principal"), articles), "classified")
    usage = found.usage if found.usage is not None else rows.sparkSession.createDataFrame([], "aiot string, model string, tokens_in long, tokens_out long, seconds double")
    return evaluation.sheet(ops, classified, truth, usage.select("aiot", "model", "tokens_in", "tokens_out"), rates, usage.select("aiot", "seconds"))


def consolidate(
    decrees: DataFrame,
    ops: DataFrame,
    call: Callable[[str, str], str] | None = None,
    settings: CallSettings | None = None,
    render: bool = True,
    template: str = rendering.TEMPLATE,
    generated_by: str = "",
    counts: dict[str, int] | None = None,
) -> Consolidation:
    """Merge, classify, replay and render; keyed by aiot throughout, so many sites run side by side.

    With ``call``, changes that no rule can place are asked of a model; without
    ``render`` there are no permits.
    """
    counts = {} if counts is None else counts
    kept = relations.without_redundant(ops, ("aiot", "source_decree", "source_article", "target_decree", "target_article"))
    articles = stored(trees.articles(decrees, "aiot", "decree_id"), "articles", counts)
    classified = stored(relations.classify(kept, decrees.select("aiot", "decree_id", "principal"), articles), "operations", counts)
    replayed = replay.run(classified, articles, decrees, call, settings)
    versions = stored(replayed.versions, "versions", counts)
    done = stored(replay.written_back(classified, versions, replayed.skipped), "resolved")
    counts["skipped"] = replayed.skipped.count()
    return Consolidation(done, versions, rendering.permits(decrees, done, versions, template, generated_by) if render else None)
