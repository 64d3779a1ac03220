"""Pages of a server on this machine."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from heliograph.sources import pages


@pytest.fixture
def server():
    asked: Counter = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            bad = self.path.startswith("/gone") and 404 or self.path.startswith("/shaky") and asked[self.path] < 3 and 503 or self.path.startswith("/down") and 500
            self.send_response(bad or 200)
            self.end_headers()
            if not bad:
                self.wfile.write(f"<p>{self.path}</p>".encode())

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", f"http://localhost:{s.server_port}", asked
    s.shutdown()


def test_source_asks_again_and_no_more_than_needed(spark, server):
    one, two, asked = server
    urls = [f"{one}/a", f"{one}/a", f"{two}/b", f"{one}/shaky", f"{two}/gone", f"{two}/down", "ftp://x.example/no"]
    got = {r.url: (r.status, r.html, r.tries) for r in pages.read_pages(spark, urls, wait=0.01, tries=3).collect()}
    assert got == {f"{one}/a": (200, "<p>/a</p>", 1), f"{two}/b": (200, "<p>/b</p>", 1), f"{one}/shaky": (200, "<p>/shaky</p>", 3), f"{two}/gone": (404, None, 1), f"{two}/down": (500, None, 3), "ftp://x.example/no": (0, None, 3)}
    assert asked == {"/a": 1, "/b": 1, "/shaky": 3, "/gone": 1, "/down": 3}
    assert pages.read_pages(spark, []).count() == 0
    with pytest.raises(ValueError, match="at most"):
        pages.read_pages(spark, ["http://x"] * (pages.MOST + 1))


def test_a_host_is_in_one_part():
    urls = [f"http://h{i % 7}.example/{i}" for i in range(100)] + ["http://H1.example/1", "http://h1.example/1"]
    lists = pages.dealt(urls, 3)
    assert sorted(u for x in lists for u in x) == sorted(set(urls)) and max(map(len, lists)) - min(map(len, lists)) <= 30
    assert all(len([1 for x in lists if any(pages.host_of(u) == f"h{k}.example" for u in x)]) == 1 for k in range(7))


def test_pace_of_a_host(server):
    import time

    one, two, _ = server
    began = time.monotonic()
    assert [x[1] for x in pages.fetched([f"{one}/1", f"{one}/2", f"{two}/3"], 1, 0.2, 0.0, 5)] == [200] * 3
    assert 0.2 <= time.monotonic() - began < 2


def test_stream_takes_up_where_it_stopped(spark, server, tmp_path):
    one, _, asked = server
    source, out, checkpoint = str(tmp_path / "urls"), str(tmp_path / "pages"), str(tmp_path / "checkpoint")
    for names in (["x", "y"], ["z", "x2"], []):
        if names:
            spark.createDataFrame([(f"{one}/{n}",) for n in names] + [(None,)], "url string").coalesce(1).write.mode("append").parquet(source)
        pages.stream_pages(spark.readStream.schema("url string").parquet(source), out, checkpoint).awaitTermination()
    assert {r.url.rsplit("/")[-1] for r in spark.read.parquet(out).collect()} == {"x", "y", "z", "x2"}
    assert asked == {"/x": 1, "/y": 1, "/z": 1, "/x2": 1}
