import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from sieveline.sources import http


@pytest.fixture()
def server():
    hits = Counter()

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            hits[self.path] += 1
            status = {"/ok": 200, "/created": 201, "/broken": 500}.get(self.path, 404)
            body = "<h1>é</h1>".encode()
            self.send_response(200 if self.path == "/second" and hits[self.path] == 2 else status)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    at = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=at.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{at.server_port}", hits
    at.shutdown()


def test_fetch(server):
    base, hits = server
    assert http.fetch(f"{base}/ok", pause=0) == (200, "<h1>é</h1>")
    assert http.fetch(f"{base}/second", pause=0)[0] == 200 and hits["/second"] == 2
    assert http.fetch(f"{base}/broken", pause=0) == (None, None) and hits["/broken"] == 3
    assert http.fetch(f"{base}/created", pause=0) == (None, None)
    assert http.fetch(f"{base}/created", strict=False, pause=0)[0] == 201


def test_data_source(spark, server):
    base, _ = server
    http.register(spark)
    df = spark.read.format("pages").option("urls", f"{base}/ok {base}/broken").option("perTask", "1").option("pause", "0").load()
    assert {r.url.rsplit("/", 1)[1]: (r.status, r.html) for r in df.collect()} == {"ok": (200, "<h1>é</h1>"), "broken": (None, None)}


def test_frontier_is_fetched(spark, server):
    base, hits = server
    frontier = spark.createDataFrame([(f"{base}/ok",), (f"{base}/ok",), (f"{base}/broken",), (None,)], "url string")
    got = {r.url.rsplit("/", 1)[1]: (r.status, r.html) for r in http.fetched(frontier, pause=0, between=0).collect()}
    assert got == {"ok": (200, "<h1>é</h1>"), "broken": (None, None)} and hits["/ok"] == 1


@pytest.mark.parametrize(
    ("body", "said", "sniff", "text"),
    [("é".encode(), None, False, "é"), ("é".encode("latin-1"), "latin-1", False, "é"), ("é".encode("latin-1"), None, True, "é"), ('<meta charset="gbk">汤'.encode("gbk"), None, True, '<meta charset="gbk">汤'), ("番茄炒蛋".encode("gb18030"), "latin-1", True, "番茄炒蛋"),
     (b"\xef\xbb\xbfa", None, True, "a"), ("aé".encode("utf-16"), None, True, "aé"), (b"a", "no-such", False, "a"), (b"", None, True, "")],
)
def test_charsets(body, said, sniff, text):
    assert http.decoded(body, said, sniff) == text
