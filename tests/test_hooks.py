"""Hooks to the outside (pages, models) and what is told of a run."""

import pytest
from pyspark.sql import functions as F

from siftworks.operators import labelling, progress
from siftworks.sources import fetch


def test_every_attempt_is_told_and_only_live_pages_pass(spark):
    def get(url: str) -> tuple[int, str]:
        if "gone" in url:
            raise ConnectionError
        return (200, "hi") if "good" in url else (500, "no")

    domains = spark.createDataFrame([("good.com",), ("gone.com",), ("bad.com",), (None,), ("good.com",)], "domain string")
    tried = fetch.attempts(domains, get, threads=2)
    assert sorted((r["domain"], r["status"], r["error"]) for r in tried.collect()) == [("bad.com", 500, None), ("gone.com", None, "ConnectionError"), ("good.com", 200, None), ("good.com", 200, None)]
    assert [tuple(r) for r in fetch.live(tried).distinct().collect()] == [("good.com", "http://good.com", "hi")]
    assert fetch.attempts(domains.limit(0), get).count() == 0


def test_what_may_pass_is_tried_again():
    def get(*errors):
        left = list(errors)

        def one(_: str) -> tuple[int, str]:
            if left:
                raise left.pop(0)
            return 200, "hi"

        return one

    def run(tries, *errors):
        waits = []
        return *fetch.get_patiently(get(*errors), "u", tries, waits.append), waits

    assert run(1) == (200, "hi", None, 1, [])
    assert run(3, ConnectionResetError(), TimeoutError()) == (200, "hi", None, 3, [5, 10])
    assert run(2, TimeoutError(), ConnectionError()) == (None, None, "ConnectionError", 2, [5])
    assert run(5, ValueError()) == (None, None, "ValueError", 1, [])


def test_http_get_from_a_server_of_this_machine(spark):
    import socket
    import threading
    import time
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/slow":
                time.sleep(1.5)
            if self.path == "/moved":
                self.send_response(302)
                self.send_header("Location", "/large")
                self.end_headers()
                return
            self.send_response(404 if self.path == "/gone" else 200)
            self.send_header("Content-Type", "text/html; charset=latin-1")
            if self.path == "/told":
                self.send_header("Content-Length", "1000")
            self.end_headers()
            self.wfile.write("é".encode("latin-1") * 1000)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        assert fetch.http_get(f"{url}/moved") == (200, "é" * 1000)
        for path in ("large", "told"):  # without and with a Content-Length
            assert fetch.http_get(f"{url}/{path}", most=1000) == (200, "é" * 1000)
            assert fetch.http_file(f"{url}/{path}", most=1000)[2] == b"\xe9" * 1000
            for get in (fetch.http_get, fetch.http_file):
                with pytest.raises(fetch.TooLarge):
                    get(f"{url}/{path}", most=999)
        one = spark.createDataFrame([(f"127.0.0.1:{server.server_port}/large",)], "domain string")
        small = lambda u: fetch.http_get(u, most=999)
        assert [(r["status"], r["html"], r["error"]) for r in fetch.attempts(one, small).collect()] == [(None, None, "TooLarge")]
        links = one.selectExpr("'2024-01-01' as dt", "concat('http://', domain) as href")
        assert [(r["content"], r["error"]) for r in fetch.downloads(links, lambda u: (200, "", fetch.http_file(u, most=999)[2])).collect()] == [(None, "TooLarge")]
        assert fetch.http_get(f"{url}/gone") == (404, "")
        try:
            fetch.http_get(f"{url}/slow", read=0.3)
            raise AssertionError("no timeout")
        except TimeoutError:
            pass
    finally:
        server.shutdown()
    with socket.socket() as closed:
        closed.bind(("127.0.0.1", 0))
        port = closed.getsockname()[1]
    assert fetch.get_patiently(fetch.http_get, f"http://127.0.0.1:{port}", 2, lambda s: None)[2:] == ("ConnectionRefusedError", 2)


def test_attempts_wait_and_end():
    def failing(*errors):
        left = list(errors)

        def model(_: str) -> str:
            e = left.pop(0) if left else "[]"
            if isinstance(e, str):
                return e
            raise e

        return model

    def run(*errors):
        waits = []
        return *labelling.ask_once(failing(*errors), "", 3, waits.append), waits

    assert run() == ("[]", None, 1, [])
    assert run(labelling.RateLimited(7), ConnectionError()) == ("[]", None, 3, [7, 15])
    assert run("no json", "```json\n{}\n```") == ("```json\n{}\n```", None, 2, [5])
    assert run(TimeoutError(), KeyError(), TimeoutError()) == (None, "TIMEOUT", 3, [5, 10])
    assert run("x", "x", "7") == (None, "JSON_ERROR", 3, [5, 10])


def test_a_batch_is_asked_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"site{k}.com", "Live", "a title", None, "plain words about shoes and coats that are sold here") for k in range(23)], "Domain string, Brand_Stage string, Title string, Meta_Description string, Page_Text string")

    def model(request: str) -> str:
        with open(tmp_path / "asked", "a") as f:
            f.write("x\n")
        return labelling.rule_model(request)

    assert labelling.label(rows, model).count() == 23
    assert (tmp_path / "asked").read_text().count("x") == 5


def test_a_pause_between_batches_in_each_lane(spark, tmp_path):
    def sleep(s: float) -> None:
        with open(tmp_path / "waits", "a") as f:
            f.write(f"{s}\n")

    requests = spark.range(10).selectExpr("id as batch", "'[]' as request").repartition(4)
    assert labelling.ask(requests, lambda r: "[]", sleep=sleep, pause=0.5, lanes=2).count() == 10
    assert (tmp_path / "waits").read_text().split() == ["0.5"] * 8


def test_counts_beside_the_rows(spark):
    df, seen = progress.counted(spark.range(10), even=F.col("id") % 2 == 0)
    assert df.count() == 10 and seen.get == {"rows": 10, "even": 5}


def test_cardinalities_and_pace(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("y",), ("z",), ("z",)], "k string")
    assert tuple(progress.cardinalities(a, b, "k").first()) == (2, 2, 1)
    assert tuple(progress.cardinalities(a.limit(0), b.limit(0), "k").first()) == (0, 0, 0)
    rows = spark.createDataFrame([(25, 100, 50.0), (0, 100, 5.0), (0, 0, 0.0)], "done long, total long, s double")
    assert [tuple(r[0]) for r in rows.select(progress.pace(F.col("done"), F.col("total"), F.col("s"))).collect()] == [(25.0, 150), (0.0, None), (100.0, None)]


def test_a_listener_tells_of_streams(spark, tmp_path):
    told = []
    listener = progress.Progress(told.append)
    spark.range(3).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert any("3 rows" in x for x in told) and told[-1].endswith("ended")
