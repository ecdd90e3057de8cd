"""Lists by pages, from a server of this process."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest

from siftwell.sources import paged


class Handler(BaseHTTPRequestHandler):
    asked: list = []
    failing: dict = {}

    def do_GET(self):
        parts = urlsplit(self.path)
        query = {k: v[0] for k, v in parse_qs(parts.query).items()}
        page, size = int(query["p"]), int(query["ps"])
        Handler.asked.append((parts.path, page, self.headers.get("X-Key"), query.get("components")))
        key = (parts.path, page)
        if Handler.failing.get(key, 0) > 0:
            Handler.failing[key] -= 1
            self.send_response(429 if page % 2 else 503)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        n = int(parts.path.strip("/").split("/")[0]) if parts.path[1:2].isdigit() else 7
        if parts.path == "/404":
            self.send_response(404)
            self.end_headers()
            return
        if parts.path == "/refused":
            self.send_response(403)
            self.end_headers()
            self.wfile.write(b"no")
            return
        rows = [{"k": k} for k in range((page - 1) * size, min(n, page * size))]
        body = rows if parts.path.endswith("bare") else {"issues": rows, "paging": {"total": n}, "total": n}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    running = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}"
    running.shutdown()


def rows(df):
    return sorted((json.loads(r["item"])["k"], r["page"], r["pos"], r["total"], r["complete"]) for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 35])
def test_pages_are_partitions(spark, server, n):
    found = paged.read_paged(spark, f"{server}/{n}/list", items="issues", total="paging.total", size="10", **{"header.X-Key": "s"})
    assert found.rdd.getNumPartitions() == max(1, -(-n // 10))
    assert rows(found) == [(k, 1 + k // 10, k % 10, n, True) for k in range(n)]
    assert {a[2] for a in Handler.asked if a[0] == f"/{n}/list"} == {"s"}


@pytest.mark.parametrize("n", [0, 9, 10, 25])
def test_until_a_short_page(spark, server, n):
    found = paged.read_paged(spark, f"{server}/{n}/bare", size="10")
    assert rows(found) == [(k, 1 + k // 10, k % 10, None, True) for k in range(n)]


def test_cut_lists_say_so(spark, server):
    told = rows(paged.read_paged(spark, f"{server}/95/list", items="issues", total="total", size="10", most="30"))
    assert [r[0] for r in told] == list(range(30)) and not any(r[4] for r in told)
    blind = rows(paged.read_paged(spark, f"{server}/95/bare", size="10", most="30"))
    assert [r[0] for r in blind] == list(range(30)) and [r[4] for r in blind] == [True] * 20 + [False] * 10


def test_busy_pages_are_asked_again(spark, server):
    Handler.failing = {("/35/busy", 1): 2, ("/35/busy", 2): 3, ("/35/busy", 4): 1}
    assert len(rows(paged.read_paged(spark, f"{server}/35/busy", items="issues", total="total", size="10", retries="3", pause="0"))) == 35
    Handler.failing = {("/35/down", 1): 9}
    with pytest.raises(Exception, match="429"):
        paged.read_paged(spark, f"{server}/35/down", items="issues", size="10", retries="2").collect()
    with pytest.raises(Exception, match="403"):
        paged.read_paged(spark, f"{server}/refused").collect()
    assert sum(a[0] == "/refused" for a in Handler.asked) == 1
    assert paged.read_paged(spark, f"{server}/404").count() == 0
    with pytest.raises(Exception, match="no answer"):
        paged.read_paged(spark, "http://127.0.0.1:9", retries="1", pause="0").collect()


def test_pauses():
    assert [paged.pause(k, None) for k in (0, 1, 20)] == [1.0, 1.7, 60.0]
    assert paged.pause(5, {"Retry-After": " 3 "}) == 3.0 and paged.pause(1, {"Retry-After": "soon"}) == 1.7


def test_issue_search(spark, server):
    found = paged.read_issue_search(spark, server, "proj", "org", size="5")
    assert [r[0] for r in rows(found)] == list(range(7))
    assert {a[3] for a in Handler.asked if a[0] == "/api/issues/search"} == {"proj"}
