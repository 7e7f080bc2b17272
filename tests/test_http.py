"""A collection over HTTP, against a server in this process: pages, samples on errors, batches that are committed or given up."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from docloom.sources import http

ITEMS = [{"_id": f"i{k}", "question": f"q{k}", "answer": "ä", "verified": None if k % 2 else "approved", "A": k, "tags": ["x"]} for k in range(23)]


@pytest.fixture
def server():
    posts, gets, faults = [], [], {"left": 0, "refuse": None}

    class Handler(BaseHTTPRequestHandler):
        def answer(self, value, status=200):
            body = json.dumps(value).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            at, asked = urlparse(self.path), parse_qs(urlparse(self.path).query)
            gets.append(self.path)
            if faults["left"]:
                faults["left"] -= 1
                return self.answer({}, 503)
            items = {"/dataset/a%20b": ITEMS, "/dataset/none": []}.get(at.path)
            if items is None:
                return self.answer({}, 404)
            if "offset" in asked:
                start = int(asked["offset"][0])
                return self.answer({"total": len(items), "items": items[start : start + int(asked["limit"][0])]})
            return self.answer(items)

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if any(c["itemId"] == faults["refuse"] for c in body["changes"]):
                return self.answer({}, 500)
            posts.append((self.path, body))
            return self.answer({"ok": True})

        def log_message(self, *args):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}/", posts, gets, faults
    made.shutdown()


def test_reads_whole_and_in_pages(spark, server):
    url, _, gets, faults = server
    whole = http.collection(spark, url, "a b").orderBy("_id").collect()
    faults["left"] = 2
    paged = http.collection(spark, url, "a b", page_size=5, wait=0.0)
    assert paged.rdd.getNumPartitions() == 5 and paged.orderBy("_id").collect() == whole and len(whole) == 23
    assert (whole[0].question, whole[0].answer, whole[0].verified, whole[0].more) == ("q0", "ä", "approved", {"A": "0", "tags": '["x"]'})
    assert any("offset=20&limit=5" in g for g in gets)
    assert http.collection(spark, url, "none", page_size=5).count() == 0


def test_samples_where_nothing_can_be_read(spark, server):
    url, _, _, faults = server
    samples = [("s", "q", "a", None, {})]
    for name in ("none", "absent"):
        assert [r["_id"] for r in http.load(spark, url, name, samples, tries=1).collect()] == ["s"]
    assert [r["_id"] for r in http.load(spark, "http://127.0.0.1:9", "x", samples, tries=1).collect()] == ["s"]
    assert http.load(spark, url, "a b", samples).count() == 23
    with pytest.raises(Exception, match="collection"):
        http.collection(spark, url, "").count()


def test_saves_one_batch(spark, server):
    url, posts, _, faults = server
    rows = [(f"i{k}", None if k % 3 else "x", "x", "now") for k in range(9)] + [(None, "a", "b", "now")]
    changes = spark.createDataFrame(rows, http.CHANGES).repartition(4)
    assert http.save(changes, url, "a b")
    bodies = [b for path, b in posts if path == "/dataset/a%20b/batch-verify"]
    sent = [c for b in bodies for c in b["changes"]]
    assert sorted(c["itemId"] for c in sent) == ["i1", "i2", "i4", "i5", "i7", "i8"] and sent[0]["new"] == "x" and sent[0]["old"] is None
    assert len({b["batch"] for b in bodies}) == 1 and [b for b in bodies if b.get("commit")] == [bodies[-1]]
    assert sorted(bodies[-1]["parts"]) == sorted({b["part"] for b in bodies if "part" in b})
    assert not http.save(changes.where("old = new"), url, "a b") and len(bodies) == len(posts)
    faults["refuse"] = "i4"
    with pytest.raises(Exception):
        http.save(changes, url, "a b", tries=1)
    assert posts[-1][1].get("abort") and not any(b.get("commit") for _, b in posts[len(bodies) :])
    with pytest.raises(Exception, match="only ever added"):
        changes.where(F.col("item_id").isNotNull()).write.format(http.FORMAT).mode("overwrite").options(url=url, collection="a b").save()
