from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from consolida.functions import identifiers as ids
from consolida.functions import texts
from consolida.sources import model_calls


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "levels"), [("IV", [4]), ("2.IX", [2, 9]), ("A", [1]), ("H", [8]), ("3.B", [3, 2]), ("I", [1]), ("C", [3]), ("10-2", [10, 2])])
def test_levels(spark, text, levels):
    assert one(spark, ids.levels(F.col("t")), t=text) == levels


@pytest.mark.parametrize(("before", "after", "yes"), [("2", "3", True), ("2", "1.2.1", False), ("7", "9", False), ("1.2", "1.3", True)])
def test_contiguous(spark, before, after, yes):
    assert one(spark, ids.contiguous(F.col("a"), F.col("b")), a=before, b=after) is yes


@pytest.mark.parametrize(("text", "valid"), [("2021-02-31", True), ("2021-1-5", True), ("2021-13-01", False), ("1899-01-01", False), ("x", False)])
def test_decree_ids(spark, text, valid):
    assert one(spark, ids.valid_decree(F.col("t")), t=text) is valid


@pytest.mark.parametrize(("phrase", "kind", "position"), [("le deuxième alinéa", "ALINEA", 2), ("la dernière phrase", "COMPLEX", None), ("la première phrase", "PHRASE", 1), ("dernier alinéa", "ALINEA", -1), ("tout", "FULL_SECTION", None)])
def test_subtarget(spark, phrase, kind, position):
    s = one(spark, texts.subtarget(F.col("t")), t=phrase)
    assert (s["type"], s["position"]) == (kind, position)


def test_accents(spark):
    assert one(spark, texts.strip_accents(F.col("t")), t="Éàç œ’–x") == "Eac x"
    assert one(spark, texts.strip_accents_full(F.col("t")), t="Éàç œ’–x") == "Eac x"


def test_separators_and_quotes(spark):
    html = 'a<a class="x" data-spec=\'page_separator\'> </a>b<blockquote k="1">c</blockquote>'
    assert one(spark, texts.strip_blockquotes(texts.strip_page_separators(F.col("t"))), t=html) == "abc"


def test_template_needs_every_name(spark):
    assert one(spark, texts.fill_template(F.col("t"), {"a": F.lit("1")}), t="x{{a}}") == "x1"
    assert one(spark, texts.fill_template(F.col("t"), {"a": F.lit("1")}), t="x") is None


def test_fenced_reply(spark):
    assert one(spark, texts.fenced_html(F.col("t")), t="so:\n```html\n<p>x</p>\n```") == "<p>x</p>"


def test_images_keep_order(spark):
    o = one(spark, texts.images_out(F.col("t")), t='<img src="a">-<img>-<img data-src="c">')
    assert o["html"] == "IMG_001-IMG_002-IMG_003"
    assert o["images"] == {"IMG_001": "a", "IMG_003": "c"}


def test_calls_retry_and_fall_back():
    seen, slept = [], []

    def call(model, prompt):
        seen.append(model)
        if model == "a":
            raise model_calls.CallFailed(503)
        return "ok"

    caller = model_calls.Caller(call, model_calls.CallSettings(models=("a", "b"), retries=2, min_interval=0.0), sleep=slept.append)
    assert caller.reply("p") == ("ok", "b", 4, None, None, None)
    assert seen == ["a", "a", "a", "b"] and len(slept) == 2
    assert not model_calls.retryable(400) and model_calls.retryable(429) and model_calls.retryable(None)


def test_replies_as_columns(spark):
    rows = spark.createDataFrame([(1, "x<target>T</target>"), (2, None)], "i int, prompt string")
    got = {r["i"]: r["reply"] for r in model_calls.with_replies(rows, "prompt", model_calls.echo_target).collect()}
    assert got == {1: "T", 2: None}


def test_equal_prompts_are_sent_once_and_in_rounds(spark):
    rows = spark.createDataFrame([(i, f"<target>{i % 7}</target>") for i in range(40)], "i int, prompt string")
    count = spark.sparkContext.accumulator(0)

    def call(model, prompt):
        count.add(1)
        return model_calls.Answer(model_calls.echo_target(model, prompt), 3, 4)

    out = model_calls.with_replies(rows, "prompt", call, model_calls.CallSettings(min_interval=0.0, batch=2)).collect()
    assert {(r["i"], r["reply"], r["tokens_in"], r["tokens_out"]) for r in out} == {(i, str(i % 7), 3, 4) for i in range(40)}
    assert count.value == 7


def test_jobs_do_not_grow_with_prompts(spark):
    """Without an interval all prompts go out in one stage, with about a batch to a task."""

    def jobs(n):
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(f"prompts{n}")
        assert not before
        spark.sparkContext.setJobGroup(f"prompts{n}", "")
        rows = spark.createDataFrame([(f"<target>{i}</target>",) for i in range(n)], "prompt string")
        out = model_calls.with_replies(rows, "prompt", model_calls.echo_target, model_calls.CallSettings(min_interval=0.0, batch=10)).collect()
        assert sorted(int(r["reply"]) for r in out) == list(range(n))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"prompts{n}"))

    few, many = jobs(20), jobs(200)
    spark.sparkContext._jsc.clearJobGroup()
    assert many <= few + 2


def test_replies_are_not_broadcast(spark):
    """The replies grow with the input, and their files are small where they are alike."""
    rows = spark.createDataFrame([(i, f"<target>{i % 7}</target>" if i else None) for i in range(40)], "i int, prompt string")
    out = model_calls.with_replies(rows, "prompt", model_calls.echo_target, model_calls.CallSettings(min_interval=0.0))
    assert {(r["i"], r["reply"]) for r in out.collect()} == {(i, str(i % 7) if i else None) for i in range(40)}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_rounds_with_an_interval_read_their_own_prompts(spark):
    rows = spark.createDataFrame([(f"<target>{i % 9}</target>",) for i in range(12)], "prompt string")
    count = spark.sparkContext.accumulator(0)

    def call(model, prompt):
        count.add(1)
        return model_calls.echo_target(model, prompt)

    out = model_calls.with_replies(rows, "prompt", call, model_calls.CallSettings(min_interval=0.01, parallelism=2, batch=2)).collect()
    assert sorted(int(r["reply"]) for r in out) == sorted(i % 9 for i in range(12)) and count.value == 9


def test_tasks_take_turns(spark):
    """Four tasks of a barrier stage together keep the interval."""
    rows = spark.createDataFrame([(f"p{i}",) for i in range(12)], "prompt string")

    def call(model, prompt):
        import time

        return repr(time.time())

    out = model_calls.with_replies(rows, "prompt", call, model_calls.CallSettings(min_interval=0.25, parallelism=4)).collect()
    times = sorted(float(r["reply"]) for r in out)
    assert len(times) == 12 and all(b - a > 0.2 for a, b in zip(times, times[1:], strict=False))


def test_slots():
    now, slept = [100.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    turns = model_calls.Slots(100.0, 1, 4, 10.0, sleep, lambda: now[0])
    turns.wait()
    assert now == [110.0]
    turns.wait()
    assert now == [150.0]
    now[0] = 235.0  # two slots have passed during a long call
    turns.wait()
    assert now == [270.0]


def test_requests_and_answers():
    assert model_calls.request("p", "m", seed=7) == {"model": "m", "messages": [{"role": "user", "content": "p"}], "temperature": 0.0, "seed": 7}
    assert model_calls.request("p", "m", reasoning="high") == {"model": "m", "messages": [{"role": "user", "content": "p"}], "reasoning_effort": "high"}
    parts = [{"type": "thinking", "text": "hm"}, {"type": "text", "text": "a"}, {"type": "text", "text": "b"}]
    usage = {"usage": {"prompt_tokens": 5, "completion_tokens": 6}}
    assert model_calls.answer_of({"choices": [{"message": {"content": parts}}], **usage}) == model_calls.Answer("ab", 5, 6)
    assert model_calls.answer_of({"content": parts, "usage": {"input_tokens": 1, "output_tokens": 2}}) == model_calls.Answer("ab", 1, 2)
    for odd in ({}, {"choices": []}, {"choices": [{"message": {"content": ""}}]}, {"error": "x"}):
        with pytest.raises(model_calls.CallFailed):
            model_calls.answer_of(odd)


def test_settings_clamped():
    assert model_calls.confidence_settings({"threshold": 170, "action": "x"}) == (100, "pass")
    assert model_calls.model_name(None, {"k": {"model_id": "m", "role": "primary"}}) == "m"
