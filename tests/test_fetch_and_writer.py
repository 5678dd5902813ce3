import json
import time
from email.utils import formatdate

import pytest
from pyspark.sql import functions as F

from sigweave.functions import text
from sigweave.operators import writer
from sigweave.sources import fetch, state
from sigweave.sources.fetch import Failure, Reply

ADDRESSES = {"a.com": ["93.184.216.34"], "b.com": ["93.184.216.34", "10.0.0.1"], "c.com": ["2606:2800:220:1::1"]}


def addresses(name):
    return [name] if name[0].isdigit() else ADDRESSES.get(name, [])


def web(pages, calls=None):
    """A transport of replies by url: a Reply, an exception, or a list of them, one a call."""
    at = {}

    def send(url, headers, timeout):
        if calls is not None:
            calls.append(url)
        found = pages.get(url, Reply(404))
        if isinstance(found, list):
            at[url] = at.get(url, -1) + 1
            found = found[min(at[url], len(found) - 1)]
        if isinstance(found, Exception):
            raise found
        return found

    return send


def got(url, pages, **more):
    waits = []
    row = fetch.one(url, [web(pages)] + ([web(more.pop("proxy"))] if "proxy" in more else []), addresses, sleep=waits.append, rand=lambda: 0.5, **more)
    return dict(zip([c.split()[0] for c in fetch.FETCHED.split(", ")], row, strict=True)), waits


def test_one_fetch():
    row, waits = got("https://a.com/", {"https://a.com/": Reply(200, {"content-type": "text/html; charset=utf-8"}, [b"a", b"b"])})
    assert (row["body"], row["status"], row["attempts"], row["kind"], waits) == (b"ab", 200, 1, None, [])
    row, _ = got("https://a.com/x", {"https://a.com/x": Reply(301, {"location": "/y"}), "https://a.com/y": Reply(302, {"location": "https://c.com/z"}), "https://c.com/z": Reply(304, {}, [b"no"])})
    assert (row["body"], row["status"], row["final_url"]) == (b"", 304, "https://c.com/z")
    row, waits = got("https://a.com/", {"https://a.com/": [Reply(500), OSError("down"), Reply(200, {}, [b"late"])]})
    assert (row["body"], row["attempts"], waits) == (b"late", 3, [0.25, 0.5])
    row, waits = got("https://a.com/", {"https://a.com/": [Reply(429, {"retry-after": "7"}), Reply(503, {"retry-after": "9"}), Reply(429)]})
    assert (row["kind"], row["status"], row["attempts"], waits) == ("rate_limit", 429, 3, [7.0, 0.5])
    row, waits = got("https://a.com/", {"https://a.com/": Reply(403)})
    assert (row["kind"], row["attempts"], waits) == ("permanent_http", 1, [])
    row, _ = got("https://a.com/", {"https://a.com/": TimeoutError()}, proxy={"https://a.com/": Reply(200, {}, [b"by proxy"])})
    assert (row["body"], row["attempts"]) == (b"by proxy", 1)


@pytest.mark.parametrize(
    "url, kind",
    [("ftp://a.com/", "security"), ("https://u:p@a.com/", "security"), ("https://x.localhost/", "security"), ("https://b.com/", "security"), ("https://nowhere.com/", "security"), ("http://127.0.0.1/", "security"), ("http://[", "security"), ("https://a.com/in", "security"), ("https://a.com/round", "permanent_http"), ("https://a.com/lost", "upstream"), ("https://a.com/big", "security"), ("https://a.com/said", "security"), ("https://a.com/slow", "timeout"), ("https://a.com/odd", "network")],
)
def test_failures(url, kind):
    pages = {
        "https://a.com/in": Reply(302, {"location": "http://192.168.0.1/"}), "https://a.com/round": Reply(302, {"location": "/round"}), "https://a.com/lost": Reply(302), "https://a.com/big": Reply(200, {}, [bytes(1 << 20)] * 6),
        "https://a.com/said": Reply(200, {"content-length": str(6 << 20)}), "https://a.com/slow": TimeoutError(), "https://a.com/odd": ConnectionResetError(),
    }
    row, _ = got(url, pages)
    assert (row["kind"], row["body"]) == (kind, None) and row["error"]


def test_retry_after():
    now = time.time()
    assert [fetch.retry_after(v, now) for v in (None, "", "soon", "nan", "12", "-3", "900", "1.5")] == [None, None, None, None, 12.0, 0.0, 30.0, 1.5]
    assert 8 <= fetch.retry_after(formatdate(now + 10, usegmt=True), now) <= 10


def test_fetched_pages(spark):
    pages = {"https://a.com/1": Reply(200, {"content-type": "text/html; charset=gb2312"}, ["摩托车".encode("gb18030")])}
    rows = spark.createDataFrame([("https://a.com/1",), ("https://a.com/1",), ("https://a.com/2",), (None,)], "url string")
    out = fetch.fetched(rows, lambda: [web(pages)], addresses, sleep=lambda s: None)
    shown = {r.url: (r.t, r.status, r.kind) for r in out.select("url", text.decode_body(F.col("body"), F.col("content_type")).alias("t"), "status", "kind").collect()}
    assert shown == {"https://a.com/1": ("摩托车", 200, None), "https://a.com/2": (None, 404, "permanent_http")}
    assert fetch.fetched(rows.limit(0), lambda: [web(pages)], addresses).count() == 0
    with pytest.raises(Failure):
        fetch.hops("ftp://x", web({}), addresses, {}, 1)


def reply(content, **more):
    return json.dumps({"choices": [{"message": {"content": content}}]} | more)


def test_asked_again():
    def run(*replies):
        waits, left = [], list(replies)

        def send(body, timeout):
            one = left.pop(0)
            if isinstance(one, Exception):
                raise one
            return one

        return writer.asked("{}", send, sleep=waits.append, rand=lambda: 0), waits

    assert run((500, None, "a"), OSError(), (200, None, "b")) == ((200, "b"), [0.5, 1.0])
    assert run((429, "4", "a"), (408, None, "b"), (429, None, "c")) == ((429, "c"), [4.0, 1.0])
    assert run((400, None, "a")) == ((400, "a"), [])
    assert run(OSError(), OSError(), TimeoutError()) == ((None, None), [0.5, 1.0])


def test_prompts_to_answers(spark):
    def send():
        def way(body, timeout):
            said = json.loads(body)
            assert said["model"] == "m" and said["messages"][0] == {"role": "system", "content": "Be short."} and said["max_tokens"] == 99
            prompt = said["messages"][1]["content"]
            if prompt == "fail":
                raise OSError
            return 200, None, reply(json.dumps({"echo": prompt}), usage={"prompt_tokens": len(prompt), "completion_tokens": 2}, model="m-1")

        return way

    rows = spark.createDataFrame([(1, "一"), (2, "fail"), (3, None)], "k int, text string")
    got = writer.replies(rows, send, "m", "Be short.", sleep=lambda s: None, most=99)
    out = got.select("k", writer.answer(F.col("status"), F.col("body"), "m").alias("a")).select("k", "a.*")
    shown = {r.k: (r.response, r.error, r.model, r.total_tokens) for r in out.collect()}
    assert shown == {1: ('{"echo": "\\u4e00"}', None, "m-1", 3), 2: (None, "network_error", "m", 0), 3: ('{"echo": ""}', None, "m-1", 2)}
    assert sorted((r.model, r.asked, r.answered, r.total_tokens) for r in writer.usage(out).collect()) == [("m", 1, 0, 0), ("m-1", 2, 2, 5)]


def test_answers(spark):
    cases = [
        (200, reply("{}", usage={"prompt_tokens": 2, "completion_tokens": 3, "total_tokens": 4}), None, 4), (200, reply("{}", usage={"prompt_tokens": -1}), "invalid_response", 0), (200, reply("{}", usage={"prompt_tokens": 1.5}), "invalid_response", 0),
        (200, reply("{}"), None, 0), (200, "<html>", "invalid_response", 0), (200, None, "invalid_response", 0), (200, reply("{"), "invalid_json", 0), (200, reply(""), "invalid_json", 0), (401, '{"error":{"code":"bad_key","type":"t"}}', "bad_key", 0), (500, "x", "http_500", 0),
        (200, '{"choices":[{"finish_reason":"length","message":{"content":"{}"}}]}', "truncated_response", 0),
    ]
    rows = spark.createDataFrame([(i, s, b) for i, (s, b, *_) in enumerate(cases)], "i int, status int, body string")
    out = rows.select("i", writer.answer(F.col("status"), F.col("body"), "m").alias("a")).orderBy("i").select("a.*").collect()
    assert [(r.error, r.total_tokens) for r in out] == [c[2:] for c in cases]
    assert all((r.response is None) == (r.error is not None) for r in out)


def test_state_files(spark, tmp_path):
    file, table = str(tmp_path / "state.json"), str(tmp_path / "state")
    assert state.read_json(spark, file).count() == 0 and state.load(spark, table).count() == 0
    (tmp_path / "state.json").write_text('{"a":{"k1":"2024-01-05T10:00:00.000Z","k2":"2023-01-01T00:00:00Z"},\n"b":{"k1":"never"},"c":{}}')
    rows = state.read_json(spark, file)
    assert sorted((r.source_slug, r.dedup_key, str(r.first_seen)) for r in rows.collect()) == [("a", "k1", "2024-01-05 10:00:00"), ("a", "k2", "2023-01-01 00:00:00"), ("b", "k1", "None")]
    now = F.lit("2024-02-01").cast("timestamp")
    state.save(rows, table, now)
    state.save(state.load(spark, table).unionByName(rows.where("dedup_key = 'k2'").withColumn("first_seen", now)), table, now)
    (tmp_path / "state" / "v2").mkdir()  # a run that ended on the way
    last = state.load(spark, table)
    assert sorted(r.body for r in state.as_json(last).collect()) == ['{"a":{"k1":"2024-01-05T10:00:00.000Z","k2":"2024-02-01T00:00:00.000Z"}}']
    (tmp_path / "state.json").write_text("no state")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        state.read_json(spark, file).collect()


def test_urls_spread_over_tasks_and_once_each(spark):
    """Urls of 64 hosts over at least as many tasks as there are cores; repeats and nulls go."""

    def sends():
        from pyspark import TaskContext

        here = str(TaskContext.get().partitionId())
        return [lambda url, headers, timeout: Reply(200, {"etag": "task " + here, "last-modified": headers.get("if-none-match", "")}, [url.encode()])]

    rows = spark.range(2000).select(F.concat(F.lit("https://h"), (F.col("id") % 64).cast("string"), F.lit(".com/"), (F.col("id") % 1500).cast("string")).alias("url")).union(spark.createDataFrame([(None,)], "url string"))
    known = spark.createDataFrame([("https://h1.com/1", "old", None), ("https://h2.com/2", None, "Tue"), (None, "x", "x")], "url string, etag string, last_modified string")
    out = fetch.fetched(rows, sends, lambda name: ["93.184.216.34"], sleep=lambda s: None, known=known, tasks=8).collect()
    want = {f"https://h{i % 64}.com/{i % 1500}" for i in range(2000)}
    assert len(out) == len(want) and {r.url for r in out} == want and all(bytes(r.body).decode() == r.url for r in out)
    assert len({r.etag for r in out}) >= 4
    tasks = {}
    for r in out:
        tasks.setdefault(r.url.split("/")[2], set()).add(r.etag)
    assert all(len(t) == 1 for t in tasks.values())
    assert {r.url: r.last_modified for r in out if r.last_modified} == {"https://h1.com/1": "old"}


def test_a_dripping_reply_ends_at_the_deadline():
    now = [0.0]

    def drip():
        while True:
            now[0] += 1.5
            yield b"x"

    closed = []
    send = lambda url, headers, timeout: Reply(302, {"location": "/drip"}, (), lambda: closed.append(url)) if url.endswith("/") else Reply(200, {}, drip(), lambda: closed.append(url))
    row = fetch.one("https://a.com/", [send], addresses, retries=0, clock=lambda: now[0])
    assert row[7] == "timeout" and 20 <= now[0] < 22 and closed == ["https://a.com/", "https://a.com/drip"]


def test_each_hosts_pace_is_held():
    now, sent = [0.0], []

    def sleep(s):
        now[0] += s

    hold = fetch.Pace(2.0, sleep, lambda: now[0])
    send = hold(lambda url, headers, timeout: sent.append((url, now[0])) or Reply(200))
    for url in ["https://a.com/1", "https://a.com/2", "https://c.com/1", "https://a.com/3"]:
        send(url, {}, 1)
    at = dict(sent)
    assert at["https://a.com/2"] - at["https://a.com/1"] >= 2 and at["https://a.com/3"] - at["https://a.com/2"] >= 2 and at["https://c.com/1"] == at["https://a.com/2"]


def test_over_a_socket():
    """A server of this machine: a reply in drips, a redirect, an error with a body, the agent's name."""
    import http.server
    import threading

    seen = []

    class Server(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.headers["user-agent"])
            if self.path == "/moved":
                self.send_response(302)
                self.send_header("location", "/page")
                self.end_headers()
            elif self.path == "/drip":
                self.send_response(200)
                self.end_headers()
                try:
                    for _ in range(100):
                        self.wfile.write(b"x")
                        self.wfile.flush()
                        time.sleep(0.1)
                except OSError:
                    pass
            else:
                self.send_response(200 if self.path == "/page" else 403)
                self.end_headers()
                self.wfile.write(b"body")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://local.test:{server.server_port}"
    plain = fetch.direct()
    here = lambda url, headers, timeout: plain(url.replace("local.test", "127.0.0.1"), headers, timeout)
    ask = lambda path, timeout=5.0: fetch.one(at + path, [here], lambda name: ["93.184.216.34"], retries=0, timeout=timeout)
    assert ask("/moved")[1:5] == (b"body", None, 200, f"{at}/page")
    assert ask("/no")[3] == 403 and ask("/no")[7] == "permanent_http"
    began = time.time()
    assert ask("/drip", 1.0)[7] == "timeout" and time.time() - began < 3
    assert set(seen) == {fetch.AGENT}
    server.shutdown()
