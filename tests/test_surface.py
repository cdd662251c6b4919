"""Settings, SQL functions, remote search, sinks, evaluation suites."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from caseloom import __main__ as cli
from caseloom.functions.sqlfunctions import register
from caseloom.operators import evals, extract, generate, retrieval
from caseloom.plans.corpus import CORPUS, QUESTIONS
from caseloom.session import Settings, shared_dir
from caseloom.sources import landing
from caseloom.sources.remote import RemoteModel


def test_settings():
    assert Settings.from_env({"CASELOOM_BASE": "s3://x", "OTHER": "y"}).base == "s3://x"
    with pytest.raises(ValueError):
        Settings(llm_backend="oracle")


def test_sql_functions(spark, message):
    register(spark)
    spark.createDataFrame([(message,)], "p string").createOrReplaceTempView("one_message")
    r = spark.sql("""SELECT hl7_component(hl7_field(hl7_segment(p, 'PID'), 4), 1) AS k, strict_date(hl7_field(hl7_segment(p, 'OBX'), 15)) AS d,
        strict_moment(hl7_field(hl7_segment(p, 'MSH'), 7)) AS t, strict_date('20260230') AS bad, hl7_segment(p, 'ZZZ') AS none, age_band(17) AS b,
        days_between(DATE '2026-01-01', DATE '2026-01-15') AS n FROM one_message""").first()
    assert (r.k, str(r.d), str(r.t), r.bad, r.none, r.b, r.n) == ("abc123", "2026-03-10", "2026-03-10 08:15:00", None, None, "5-17", 14)


def test_remote_search(spark):
    q = spark.createDataFrame([("a", "x"), ("b", None)], "query_id string, question string")
    hits = retrieval.remote_hits(q, lambda t, k: [("d2", 1.0), ("d1", 1.0), ("d3", 9.0)][: k if t else 0], k=2)
    assert [(r.query_id, r.id, r["rank"]) for r in hits.orderBy("rank").collect()] == [("a", "d1", 1), ("a", "d2", 2)]
    sure = {r.query_id: r.refused for r in retrieval.confidence(q, hits).collect()}
    assert sure == {"a": True, "b": True}


def test_sinks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert landing.materialise(df, "a_view").count() == 1 and spark.sql("SELECT y FROM a_view").first().y == "a"
    landing.write_single_file(df, f"{tmp_path}/one")
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    df.write.parquet(f"{tmp_path}/many/p=1")
    df.drop("y").write.parquet(f"{tmp_path}/many/p=2")
    assert landing.read_merged(spark, f"{tmp_path}/many").count() == 2
    landing.write_sidecar(spark, {"a": 0}, f"{tmp_path}/side/c.json")
    landing.write_sidecar(spark, {"a": 1}, f"{tmp_path}/side/c.json")
    assert landing.read_sidecar(spark, f"{tmp_path}/side/c.json") == {"a": 1}
    assert json.loads((tmp_path / "side/c.json").read_text()) == {"a": 1} and landing.read_json_document(spark, f"{tmp_path}/side/c.json").first().a == 1
    (tmp_path / "lines.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert landing.read_json_lines(spark, f"{tmp_path}/lines.jsonl").count() == 2


def test_suites_pass_the_gates(spark):
    questions = spark.createDataFrame(QUESTIONS, "query_id string, question string, expect_doc string, answerable boolean")
    m = evals.run_suites(generate.golden_sample(spark, days=60, facilities=4, rate=0.5, most=50), spark.createDataFrame(CORPUS, "id string, title string, text string"), questions)
    assert evals.gate_breaches(m) == [] and m["symptom_f1"] == 1.0 and m["n_cases"] == 50


class Service(BaseHTTPRequestHandler):
    """Answers chat completions with the rule backend's kind of reply, and searches."""

    seen: list = []

    def do_POST(self):  # noqa: N802
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append(asked)
        if "search" in asked:
            out = {"value": [{"id": "doc-mumps-school", "score": 9.0}, {"id": "doc-noro-kitchen", "score": 2.0}][: asked["top"]]}
        else:
            text = json.dumps({"symptoms": ["febrile"], "onset_date": "2026-03-01", "exposure_setting": "Lake", "recent_travel": True})
            out = {"choices": [{"message": {"content": text}}], "usage": {"prompt_tokens": 7, "completion_tokens": 3}}
        body = json.dumps(out).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/"
    server.shutdown()


def test_remote_model_and_search(spark, service):
    model = RemoteModel(service, "m1")
    reply = model.complete("task", "note", json_mode=True)
    assert reply.usage == {"prompt_tokens": 7, "completion_tokens": 3} and reply.model == "m1" and reply.attempts == 1
    assert Service.seen[-1]["response_format"] == {"type": "json_object"} and Service.seen[-1]["temperature"] == 0
    notes = spark.createDataFrame([(1, "Fever since 2026-03-01."), (2, "Fever.")], "id int, note string")
    got = {r.id: r for r in extract.extract_all(notes, "id", Settings(llm_backend="remote", llm_url=service, model_deployment="m1")).collect()}
    assert (got[1].symptoms_mapped, got[1].model, got[1].recent_travel) == (["fever"], "m1", True) and got[2].extraction_failed and got[2].attempts == 3
    corpus = spark.createDataFrame(CORPUS, "id string, title string, text string")
    asked = spark.createDataFrame([("q", "How long are pupils with mumps excluded?")], "query_id string, question string")
    answer = cli.ask(spark, None, Settings(search_backend="remote", search_url=service), corpus, asked).first()
    assert answer.grounded and answer.citations == ["doc-mumps-school"] and answer.retrieved == ["doc-mumps-school", "doc-noro-kitchen"]
    with pytest.raises(ValueError):
        Settings(llm_backend="remote")


def test_rule_backend_by_the_settings(spark):
    notes = spark.createDataFrame([(1, "Fever. Symptom onset reported as 2026-03-01. Exposure history: Lake."), (2, "Onset reported as 2026-02-31."), (3, None)], "id int, note string")
    got = {r.id: r for r in extract.extract_all(notes, "id", Settings()).collect()}
    assert (got[1].symptoms_mapped, str(got[1].onset_date), got[1].exposure_setting, got[1].extraction_failed) == (["fever"], "2026-03-01", "lake", False)
    assert got[2].extraction_failed and got[2].failure_reason and got[2].symptoms_mapped == [] and not got[3].extraction_failed
    reply = json.loads(notes.select(extract.rule_reply(notes.note).alias("r")).first().r)
    assert extract.parse_reply(json.dumps(reply))["exposure_setting"] == "lake"


def test_index_is_built_once_and_opened_again(spark, tmp_path):
    corpus = spark.createDataFrame([*CORPUS, ("doc-empty", None, None)], "id string, title string, text string")
    asked = spark.createDataFrame([q[:2] for q in QUESTIONS], "query_id string, question string")
    lake = landing.Lake(str(tmp_path))
    answers = lambda **kw: sorted(map(str, cli.ask(spark, lake, Settings(), corpus, asked, **kw).collect()))
    direct = answers()
    assert answers(build_index=True) == direct
    index = retrieval.Bm25Index(spark, lake.uri("ml", "guidance_index"))
    scores = lambda df: {(r.query_id, r.id): round(r.score, 9) for r in df.collect()}
    assert index.n == len(CORPUS) + 1 and scores(index.scores(asked)) == scores(retrieval.bm25_scores(corpus, asked))
    assert answers() == direct
    empty = retrieval.Bm25Index.build(corpus.limit(0), str(tmp_path / "empty"))
    assert empty.search(asked).count() == 0 and retrieval.bm25_scores(corpus.limit(0), asked).count() == 0


def test_a_cluster_without_a_shared_folder_is_refused():
    class Elsewhere:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

    spark_ = type("S", (), {"conf": {}, "sparkContext": Elsewhere()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(spark_)
