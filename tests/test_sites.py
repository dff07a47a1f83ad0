"""Files of sites, settings, calls over HTTP and the command line, from folders to permits and score sheets."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from consolida import cli
from consolida import settings as config
from consolida.sources import http_calls, site_files
from consolida.sources.model_calls import Answer, CallFailed

ROWS = "aiot string, filename string, nth long, text string"


def test_files_are_written_whole(spark, tmp_path):
    rows = [("a", "x.txt", n, f"{n}\n") for n in range(200)] + [("a", "y é.html", 0, None), ("b", "x.txt", 5, "later"), ("b", "x.txt", 1, "sooner ")]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    site_files.write(df, str(tmp_path))
    assert (tmp_path / "a" / "x.txt").read_text() == "".join(f"{n}\n" for n in range(200))
    got = {(r["aiot"], r["filename"]): r["text"] for r in site_files.read(spark, str(tmp_path)).collect()}
    assert got["b", "x.txt"] == "sooner later" and got["a", "y é.html"] == "" and len(got) == 3
    site_files.write(spark.createDataFrame([("b", "x.txt", 0, "new")], ROWS), f"file://{tmp_path}")
    assert [r["text"] for r in site_files.read(spark, str(tmp_path), "x.*").where("aiot = 'b'").collect()] == ["new"]
    assert site_files.read(spark, str(tmp_path / "none")).count() == 0


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    @F.udf("string")
    def fails(text):
        if text == "99":
            raise ValueError("no text")
        return text

    rows = spark.createDataFrame([("a", f"f{n % 3}", n, str(n)) for n in range(100)], ROWS).withColumn("text", fails("text"))
    with pytest.raises(Exception, match="no text"):
        site_files.write(rows, str(tmp_path))
    assert [p.name for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(site_files.UNFINISHED)] == []
    assert site_files.read(spark, str(tmp_path)).count() == 0


def test_settings(tmp_path):
    path = tmp_path / "s.json"
    models = {"one": {"model_id": "m1"}, "two": {"model_id": "m2", "alias": "other"}}
    path.write_text(json.dumps({"models": models, "retries": 2, "confidence_threshold": 170, "confidence_action": "retry"}))
    found = config.load(str(path), {"CONSOLIDA_RETRIES": "7", "CONSOLIDA_MIN_INTERVAL": "0.5", "CONSOLIDA_MODEL": "other"})
    assert (found.retries, found.min_interval, found.chosen(), found.confidence()) == (7, 0.5, ("m2",), (100, True))
    assert found.calls().models == ("m2",)
    assert config.load(str(path), {"CONSOLIDA_NO_MODEL": "1"}).chosen() == () == config.load(None, {}).chosen()
    assert config.load(None, {"CONSOLIDA_CONFIDENCE_ENABLED": "no"}).confidence() == (None, False)
    for text, environment in (("[1]", {}), ("{", {}), ('{"unknown": 1}', {}), ('{"retries": "x"}', {}), ("{}", {"CONSOLIDA_TIMEOUT": "long"}), (json.dumps({"models": models, "primary": "three"}), {})):
        path.write_text(text)
        with pytest.raises(config.SettingsError):
            config.load(str(path), environment)
    with pytest.raises(config.SettingsError):
        config.load(str(tmp_path / "none.json"), {})


def test_logging(tmp_path):
    config.start_logging(config.Settings(log_file=str(tmp_path / "logs" / "run.log"), log_level="warning"))
    config.LOG.info("not this")
    config.LOG.warning("but this")
    assert [line.split(" consolida: ")[1] for line in (tmp_path / "logs" / "run.log").read_text().splitlines()] == ["but this"]
    with pytest.raises(config.SettingsError):
        config.start_logging(config.Settings(log_level="loud"))
    config.start_logging(config.Settings())


class Model(BaseHTTPRequestHandler):
    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        prompt = body["messages"][0]["content"]
        code = int(prompt.partition("code ")[2][:3]) if prompt.startswith("code ") else 200
        self.send_response(code)
        if code == 429:
            self.send_header("Retry-After", "7")
        self.end_headers()
        reply = {"choices": [{"message": {"content": f"{body['model']} {self.headers.get('Authorization')} {prompt}"}}], "usage": {"prompt_tokens": 3, "completion_tokens": 4}}
        self.wfile.write(json.dumps({} if "odd" in prompt else reply).encode())

    def log_message(self, *args):
        return


@pytest.fixture
def url():
    server = HTTPServer(("127.0.0.1", 0), Model)
    thread = threading.Thread(target=server.serve_forever, daemon=True)
    thread.start()
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()
    server.server_close()


def test_calls_over_http(url, monkeypatch):
    monkeypatch.setenv("A_KEY", "secret")
    call = http_calls.caller({"one": {"model_id": "m", "url": url, "key_variable": "A_KEY"}, "gone": {"model_id": "g", "url": "http://127.0.0.1:1/"}}, 5)
    assert call("m", "hello") == Answer("m Bearer secret hello", 3, 4)
    for prompt, status, after in (("code 429", 429, 7.0), ("code 500", 500, None), ("code 400", 400, None), ("odd", None, None)):
        with pytest.raises(CallFailed) as failed:
            call("m", prompt)
        assert (failed.value.status, failed.value.retry_after) == (status, after)
    with pytest.raises(CallFailed):
        call("g", "lost")


def decree(sections):
    return f'<html><body data-arretify_version="0.2.1"><main>{sections}</main></body></html>'


FIRST = decree('<section data-spec="section" data-type="article" data-number="1"><h2 data-spec="section_title">Article 1</h2><div data-spec="alinea" data-number="1">old text</div></section><section data-spec="section" data-type="article" data-number="2" data-title="FRAIS"><div>costs</div></section>')
LATER = decree(
    '<section data-spec="section" data-type="article" data-number="3"><div data-spec="alinea" data-number="1">L\'<a data-spec="section_reference" data-type="article" data-tag_id="r" data-parent_reference="d" data-start_num="1">article 1</a> de l\'<a data-spec="document_reference" data-tag_id="d" data-date="2010-01-01">arrêté</a> est remplacé par : <q>new text</q></div></section>'
)


@pytest.fixture
def folder(tmp_path):
    for site in ("0001", "0002"):
        (tmp_path / "in" / site).mkdir(parents=True)
        (tmp_path / "in" / site / "2010-01-01.html").write_text(FIRST)
        (tmp_path / "in" / site / "2012-05-06.html").write_text(LATER)
    (tmp_path / "in" / "0002" / "2012-05-06_rapport.html").write_text("no decree")
    return tmp_path


def test_run(spark, folder):
    assert cli.main(["run", str(folder / "in"), "--output", str(folder / "out"), "--tagged-output", str(folder / "tagged"), "--principal-id", "2010-01-01"], spark) == 0
    for site in ("0001", "0002"):
        ops = json.loads((folder / "out" / site / "operations.json").read_text())
        assert [(o["id"], o["operation_type"], o["operand"], o["source_id"], o["target_id"]) for o in ops] == [("tag_op_1", "REPLACE", "new text", {"arrete_id": "2012-05-06", "article_id": "3"}, {"arrete_id": "2010-01-01", "article_id": "1"})]
        history = json.loads((folder / "out" / site / "history.json").read_text())
        assert [v["content"] for v in history["2010-01-01#1"]] == ['<div data-spec="alinea" data-number="1">old text</div>', "new text"]
        assert list(history) == sorted(history)
        permit = (folder / "out" / site / "permis.html").read_text()
        assert "new text</section>" in permit and "costs" not in permit and f"</strong> {site}</p>" in permit
        assert "Opération de consolidation résolue (modification) dans l'article 1 de l'arrêté 2010-01-01" in permit
        assert sorted(p.name for p in (folder / "tagged" / site).iterdir()) == ["2010-01-01.html", "2012-05-06.html"]


def test_run_with_given_operations(spark, folder):
    assert cli.main(["run", str(folder / "in"), "--output", str(folder / "out"), "--aiot", "0001"], spark) == 0
    given = folder / "out" / "0001" / "operations.json"
    ops = json.loads(given.read_text())
    given.write_text(json.dumps([{**ops[0], "operand": "<p>given</p>"}]))
    assert cli.main(["run", str(folder / "in"), "--output", str(folder / "again"), "--aiot", "0001", "--operations-from", str(folder / "out"), "--no-rendering"], spark) == 0
    assert "given" in (folder / "again" / "0001" / "history.json").read_text()
    assert not (folder / "again" / "0001" / "permis.html").exists() and not (folder / "again" / "0002").exists()


def test_run_fails_with_a_message(spark, folder, capsys):
    for more in (["--include", "1999-01-01"], ["--principal-id", "1999-01-01"], ["--aiot", "9"]):
        assert cli.main(["run", str(folder / "in"), "--output", str(folder / "out"), *more], spark) == 1
    (folder / "empty").mkdir()
    assert cli.main(["run", str(folder / "empty"), "--output", str(folder / "out")], spark) == 1
    assert cli.main(["--settings", str(folder / "none.json"), "run", str(folder / "in"), "--output", str(folder / "out")], spark) == 1
    with pytest.raises(SystemExit):
        cli.main([], spark)


def test_evaluate(spark, folder):
    """One operation found of the truth's two; a kind that is not compared; a site without truth."""
    truth = [
        {"id": "1", "operation_type": kind, "source_id": {"arrete_id": "2012-05-06", "article_id": source}, "target_id": {"arrete_id": "2010-01-01", "article_id": target}}
        for kind, source, target in (("REPLACE", "3", "1"), ("ADD", "3", "NEW_ARTICLE:9"), ("AUTRE", "3", "2"))
    ]
    (folder / "truth" / "0001").mkdir(parents=True)
    (folder / "truth" / "0001" / "operations.json").write_text(json.dumps(truth))
    assert cli.main(["evaluate", str(folder / "in"), "--truth", str(folder / "truth"), "--output", str(folder / "eval")], spark) == 0
    sheet = spark.read.option("header", True).csv(f"{folder}/eval/*").collect()
    assert {(r["aiot"], r["truth"], r["detected"], r["validated"], r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in sheet} == {(a, "2", "1", "1", "1", "0", "1", "1.0", "0.5") for a in ("0001", "TOTAL")}
    assert len(sheet[0]) == 14 + ("run" in sheet[0].asDict())


def test_a_model_over_http_finds_operations(spark, folder, monkeypatch):
    """The whole way with a model: chunks, prompts over HTTP, merge with the grammar's operations, tokens."""

    class Finder(Model):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            assert "LATER" not in body["messages"][0]["content"]
            ops = [{"operation_type": "ADD", "source_article": "3", "target_arrete": "2010-01-01", "target_article": "NEW_ARTICLE:1.1", "new_content_start_marker": "new", "new_content_end_marker": "TEXT", "confidence_score": 95}]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": json.dumps(ops)}}], "usage": {"prompt_tokens": 11, "completion_tokens": 5}}).encode())

    server = HTTPServer(("127.0.0.1", 0), Finder)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    models = {"one": {"model_id": "m", "url": f"http://127.0.0.1:{server.server_port}/"}}
    (folder / "s.json").write_text(json.dumps({"models": models, "min_interval": 0.05, "parallelism": 2}))
    assert cli.main(["--settings", str(folder / "s.json"), "run", str(folder / "in"), "--output", str(folder / "out"), "--tagging-ops"], spark) == 0
    server.shutdown()
    server.server_close()
    for site in ("0001", "0002"):
        ops = json.loads((folder / "out" / site / "operations.json").read_text())
        assert [(o["id"], o["origin"], o["target_id"]["article_id"], o["operand"]) for o in ops] == [("tag_op_1", "Regex", "1", "new text"), ("op_1", "LLM", "NEW_ARTICLE:1.1", "new text")]
        permit = (folder / "out" / site / "permis.html").read_text()
        assert permit.index('data-number="1"') < permit.index('data-number="1.1"') and "<footer>m</footer>" in permit
