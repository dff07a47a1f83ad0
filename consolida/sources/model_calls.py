"""Calls to a language model as a column, with retries, a second model and a rate limit.

The call itself is a plain function ``(model, prompt) -> reply`` that the caller
supplies; ``echo_target`` stands in for it in tests and offline runs.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.plans.storage import Appended, stored


class CallFailed(Exception):
    """A call that gave no reply; ``status`` is an HTTP status or None for time-outs and lost connections."""

    def __init__(self, status: int | None = None, retry_after: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.retry_after = status, retry_after


@dataclass(frozen=True)
class CallSettings:
    """Limits of the shipped configuration (fixed values), over ``parallelism`` workers in all."""

    models: tuple[str, ...] = ("primary",)
    retries: int = 5
    base_delay: float = 10.0
    max_delay: float = 60.0
    jitter: float = 0.2
    min_interval: float = 10.0
    parallelism: int = 1
    batch: int = 1000


def retryable(status: int | None) -> bool:
    return status is None or status == 429 or status >= 500


def delay(settings: CallSettings, attempt: int, asked: float | None, draw: float) -> float:
    """Seconds before the next attempt: what the server asked for, else doubling up to a limit, jittered."""
    if asked is not None:
        return asked
    return min(settings.base_delay * 2 ** (attempt - 1), settings.max_delay) * (1 - settings.jitter + 2 * settings.jitter * draw)


@dataclass
class Caller:
    """One task's calls; ``turns`` tells when it may call, if there is a limit on the rate."""

    call: Callable[[str, str], str]
    settings: CallSettings
    sleep: Callable[[float], None] = time.sleep
    turns: Slots | None = None

    def reply(self, prompt: str) -> tuple:
        """(reply, model, attempts, error, tokens in, tokens out) after retries with each model in turn."""
        attempts, error = 0, None
        for model in self.settings.models:
            for attempt in range(1, self.settings.retries + 2):
                if self.turns:
                    self.turns.wait()
                attempts += 1
                try:
                    found = self.call(model, prompt)
                    found = found if isinstance(found, Answer) else Answer(found)
                    return found.text, model, attempts, None, found.tokens_in, found.tokens_out
                except CallFailed as failed:
                    error = str(failed)
                    if not retryable(failed.status) or attempt > self.settings.retries:
                        break
                    self.sleep(delay(self.settings, attempt, failed.retry_after, random.random()))
        return None, None, attempts, error, None, None


REPLY = "reply string, model string, attempts int, call_error string, tokens_in long, tokens_out long, seconds double"


@dataclass(frozen=True)
class Answer:
    """A reply with the tokens it took; a call may also give the bare text."""

    text: str
    tokens_in: int | None = None
    tokens_out: int | None = None


def request(prompt: str, model_id: str, temperature: float | None = 0.0, reasoning: str | None = None, seed: int | None = None, max_tokens: int | None = None) -> dict:
    """The body of a chat request for one prompt; models that reason take an effort and no temperature."""
    more = {"reasoning_effort": reasoning} if reasoning else {"temperature": temperature}
    body = {"model": model_id, "messages": [{"role": "user", "content": prompt}], **more, "seed": seed, "max_tokens": max_tokens}
    return {k: v for k, v in body.items() if v is not None}


def answer_of(body: dict) -> Answer:
    """Text and usage from the body of a reply, whether it lists choices or the parts of one message; thoughts are left out."""
    try:
        content = body["content"] if "content" in body else body["choices"][0]["message"]["content"]
    except (KeyError, IndexError, TypeError) as odd:
        raise CallFailed(None) from odd
    if isinstance(content, list):
        content = "".join(p.get("text") or "" for p in content if isinstance(p, dict) and p.get("type", "text") == "text")
    if not content:
        raise CallFailed(None)
    usage = body.get("usage") or {}
    count = lambda *names: next((int(usage[n]) for n in names if usage.get(n) is not None), None)
    return Answer(content, count("prompt_tokens", "input_tokens"), count("completion_tokens", "output_tokens"))


class Slots:
    """Times at which one of several tasks may call: together they keep the interval, whichever is fast or slow."""

    def __init__(self, begin: float, nth: int, tasks: int, interval: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time):
        self.next, self.step, self.sleep, self.clock = begin + nth * interval, tasks * interval, sleep, clock

    def wait(self) -> None:
        left = self.next - self.clock()
        if left > 0:
            self.sleep(left)
        else:  # slots that have passed are not made up for
            self.next += -(left // self.step) * self.step
            if (late := self.next - self.clock()) > 0:
                self.sleep(late)
        self.next += self.step


def _asked(batches: Iterator[pd.DataFrame], prompt: str, call: Callable[[str, str], str], settings: CallSettings) -> Iterator[pd.DataFrame]:
    caller = Caller(call, settings)
    if settings.min_interval > 0:
        task = BarrierTaskContext.get()
        begin = max(map(float, task.allGather(repr(time.time()))))  # all tasks have begun by then
        caller.turns = Slots(begin, task.partitionId(), len(task.getTaskInfos()), settings.min_interval)
    for pdf in batches:
        found = []
        for p in pdf[prompt]:
            begin = time.monotonic()
            found.append((*caller.reply(p), time.monotonic() - begin))
        names = [c.split()[0] for c in REPLY.split(", ")]
        yield pdf.assign(**{name: pd.Series([f[k] for f in found], dtype=object, index=pdf.index) for k, name in enumerate(names)})


def with_replies(rows: DataFrame, prompt: str, call: Callable[[str, str], str], settings: CallSettings | None = None) -> DataFrame:
    """``rows`` with ``reply``, ``model``, ``attempts``, ``call_error`` and tokens; null prompts are not sent.

    Equal prompts are sent once.  Without an interval they go out in one stage,
    ``settings.batch`` or so to a task, and each task's replies are stored when
    it ends, so a lost executor costs the calls of its running tasks.  With an
    interval they go out in rounds of about ``settings.batch``: a round is one
    barrier stage of ``settings.parallelism`` tasks that take turns by their
    numbers, reads its own prompts only, and is stored before the next begins.
    Replies meet their rows by sorting: a table of like replies is small as a
    file, by which Spark would take it for one to be broadcast, and not in memory.
    """
    settings = settings or CallSettings(min_interval=0.0)
    prompts = stored(rows.where(F.col(prompt).isNotNull()).select(F.sha2(prompt, 256).alias("_key"), F.col(prompt).alias("_prompt")).groupBy("_key").agg(F.first("_prompt").alias("_prompt")), "prompts")
    rounds = max(1, -(-prompts.count() // settings.batch))
    ddl = f"_key string, _prompt string, {REPLY}"
    if settings.min_interval > 0:
        replies = Appended(rows.sparkSession, "replies")
        if rounds > 1:
            prompts = stored(prompts.withColumn("_round", F.pmod(F.xxhash64("_key"), F.lit(rounds))).repartition("_round"), "rounds", by="_round")
        for k in range(rounds):
            some = prompts.where(F.col("_round") == k).drop("_round") if rounds > 1 else prompts
            found = some.repartition(settings.parallelism, "_key").mapInPandas(lambda it: _asked(it, "_prompt", call, settings), ddl, barrier=True)
            replies.add(found.drop("_prompt"))
        done = replies.read()
    else:
        found = prompts.repartition(rounds, "_key").mapInPandas(lambda it: _asked(it, "_prompt", call, settings), ddl)
        done = stored(found.drop("_prompt"), "replies")
    met = rows.withColumn("_key", F.sha2(prompt, 256)).join(done.hint("merge"), "_key", "left").drop("_key")
    return met.withColumn("attempts", F.coalesce("attempts", F.lit(0)))


def echo_target(model: str, prompt: str) -> str:
    """A stand-in that gives the target back unchanged."""
    return prompt.partition("<target>")[2].partition("</target>")[0].strip()


#: What a model is asked about a chunk of a decree: fields of the JSON objects and how kinds and articles are written.
DETECTION = """List the changes that the decree of {decree} makes to earlier decrees of the same authority, as a JSON array and nothing else; [] if it makes none.
Announcements, plain references and decrees of ministries are no changes. One object for each changed article:
{"operation_type": "ADD" | "REPLACE" | "REMOVE" | "AUTRE", "source_article": number of the section that says so, with "APPENDIX:" before it inside the appendix,
"target_arrete": "YYYY-MM-DD", "target_article": number | "NEW_ARTICLE:number" | "END" | "ALL" (only to abrogate or replace a whole decree),
"sub_target": the part of the article in the decree's words | "ALL" | null, "new_content_start_marker" and "new_content_end_marker": exact beginning and end of the new text, tags included | null,
"confidence_score": 0 to 100}
Abrogating and replacing is REPLACE. A postponed date is REPLACE of that part.
<decree>
{chunk}
</decree>"""


def detection_prompt(chunk: Column, decree: Column) -> Column:
    before, _, after = DETECTION.partition("{chunk}")
    return F.concat(F.replace(F.lit(before), F.lit("{decree}"), decree), chunk, F.lit(after))


#: What a model is asked to do with a part of an article.
TASKS = {"ADD": "insert the new content where the part is described", "REPLACE": "replace the described part by the new content", "REMOVE": "remove the described part"}


def change_prompt(kind: str, article: str, target: str, part: str | None, operand: str | None = None, source: str | None = None) -> str:
    """The request for one change of an article; the reply is the article's whole new HTML."""
    blocks = [("source", source), ("target", target), ("part", part), ("content", operand)]
    head = f"In article {article}, {TASKS[kind]}. Answer with the whole HTML of the article and nothing else."
    return "\n".join([head, *(f"<{name}>\n{text}\n</{name}>" for name, text in blocks if text and text.strip())])


def model_name(key: str | None, known: dict[str, dict], order: tuple[str, str] = ("primary", "secondary")) -> str:
    """Id of a model by key, alias or id; the first of ``order`` without a key."""
    for name in ([key] if key else order):
        for k, entry in known.items():
            if name in (k, entry.get("alias"), entry.get("model_id"), entry.get("role")):
                return entry["model_id"]
    raise KeyError(key or order)


def confidence_settings(found: dict) -> tuple[int, str]:
    """(threshold within 0 to 100, ``pass`` or ``retry``)."""
    threshold = max(0, min(100, int(found.get("threshold", 70))))
    action = found.get("action", "pass")
    return threshold, action if action in ("pass", "retry") else "pass"
