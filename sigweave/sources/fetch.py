"""Pages over HTTP: a table of urls in, a row an url out, whatever becomes of it.

What sends a request is an argument, so tests and other transports need no network. Urls are checked before every
hop; bodies are read up to a limit, and a request has one deadline from the first hop to the last byte. Urls are dealt
by host, so a host's urls are in one task, which holds the pace for that host; a task has several requests under way. A
task that is run again asks again.
"""

from __future__ import annotations

import contextlib
import http.client
import itertools
import random
import socket
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.functions import urls

# Seconds, hops, bytes, retries and waits of a request, and what it accepts.
TIMEOUT, HOPS, BYTES, RETRIES, MOST_RETRIES, BACKOFF, MOST_WAIT = 20.0, 5, 5 * 1024 * 1024, 2, 5, 0.5, 30.0
ACCEPT = "application/json, application/rss+xml, application/atom+xml, text/html;q=0.9, */*;q=0.5"
MOVED = (301, 302, 303, 307, 308)
#: Requests that a task has under way, and seconds between two to one host.
FLIGHT, PACE = 5, 0.2
AGENT = "sigweave/1"

FETCHED = "url string, body binary, content_type string, status int, final_url string, attempts int, error string, kind string, etag string, last_modified string"


@dataclass(frozen=True)
class Reply:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: Iterable[bytes] = ()
    close: Callable[[], None] = lambda: None


#: url, headers and seconds to a reply that doesn't follow redirects. Raises TimeoutError or another OSError.
Send = Callable[[str, dict[str, str], float], Reply]


class Failure(Exception):
    def __init__(self, what: str, kind: str, again: bool, status: int | None = None, wait: float | None = None):
        super().__init__(what)
        self.kind, self.again, self.status, self.wait = kind, again, status, wait


def retry_after(value: str | None, now: float) -> float | None:
    """Seconds to wait by the header: a number or a date, from 0 to MOST_WAIT; null for anything else."""
    if not value:
        return None
    try:
        seconds = float(value)
    except ValueError:
        try:
            seconds = parsedate_to_datetime(value).timestamp() - now
        except (ValueError, TypeError):
            return None
    return min(MOST_WAIT, max(0.0, seconds)) if seconds == seconds else None


def public(url: str, addresses: Callable[[str], list[str]]) -> str | None:
    """Why a url must not be fetched; null for one that may."""
    try:
        parts = urlsplit(url)
        name = (parts.hostname or "").lower()
    except ValueError:
        return "no url"
    if parts.scheme.lower() not in ("http", "https") or not name:
        return "only http and https"
    if parts.username or parts.password:
        return "credentials in the url"
    if name == "localhost" or name.endswith(".localhost"):
        return "a local host"
    found = addresses(name)
    if not found:
        return f"no address of {name}"
    return f"a private address of {name}" if any(urls.private(a) for a in found) else None


def addresses_of(name: str) -> list[str]:
    try:
        return sorted({str(a[4][0]) for a in socket.getaddrinfo(name, None)})
    except OSError:
        return []


def _limited(parts: Iterable[bytes], status: int, left: Callable[[], float]) -> bytes:
    out = bytearray()
    for part in parts:
        out += part
        if len(out) > BYTES:
            raise Failure(f"over {BYTES} bytes", "security", False, status)
        left()
    return bytes(out)


def hops(url: str, send: Send, addresses: Callable[[str], list[str]], headers: dict[str, str], timeout: float, clock: Callable[[], float] = time.monotonic) -> tuple[Reply, bytes, str]:
    """The reply at the end of the redirects, its body and its url, all within `timeout` seconds."""
    end = clock() + timeout

    def left() -> float:
        if (seconds := end - clock()) <= 0:
            raise TimeoutError
        return seconds

    for hop in range(HOPS + 1):
        why = public(url, addresses)
        if why:
            raise Failure(why, "security", False)
        reply = None
        try:
            reply = send(url, {"accept": ACCEPT, "user-agent": AGENT} | headers, left())
            if reply.status in MOVED:
                to = reply.headers.get("location")
                if not to:
                    raise Failure("a redirect to nowhere", "upstream", True)
                if hop == HOPS:
                    raise Failure("too many redirects", "permanent_http", False, reply.status)
                url = urljoin(url, to)
                continue
            if reply.status == 304:
                return reply, b"", url
            if not 200 <= reply.status < 300:
                kind = "rate_limit" if reply.status == 429 else "upstream" if reply.status in (408, 425) or reply.status >= 500 else "permanent_http"
                wait = retry_after(reply.headers.get("retry-after"), time.time()) if reply.status == 429 else None
                raise Failure(f"HTTP {reply.status}", kind, kind != "permanent_http", reply.status, wait)
            size = reply.headers.get("content-length", "")
            if size.isdigit() and int(size) > BYTES:
                raise Failure(f"over {BYTES} bytes", "security", False, reply.status)
            return reply, _limited(reply.body, reply.status, left), url
        except TimeoutError:
            raise Failure(f"no reply in {timeout:g} s", "timeout", True) from None
        except (OSError, http.client.HTTPException, ValueError) as e:
            raise Failure(type(e).__name__, "network", True) from None
        finally:
            if reply:
                with contextlib.suppress(OSError):
                    reply.close()
    raise AssertionError


def one(url: str, ways: list[Send], addresses=addresses_of, headers=None, timeout=TIMEOUT, retries=RETRIES, backoff=BACKOFF, sleep=time.sleep, rand=random.random, clock=time.monotonic) -> tuple:
    """A row of FETCHED. ways: how to send, the second (a proxy) where the first finds no network or no time."""
    retries, backoff = min(max(retries, 0), MOST_RETRIES), min(max(backoff, 0.05), MOST_WAIT)
    for attempt in range(1, retries + 2):
        for send in ways:
            try:
                reply, body, final = hops(url, send, addresses, headers or {}, timeout, clock)
                return url, body, reply.headers.get("content-type"), reply.status, final, attempt, None, None, reply.headers.get("etag"), reply.headers.get("last-modified")
            except Failure as e:
                failed = e
                if e.kind not in ("network", "timeout"):
                    break
        if not failed.again or attempt > retries:
            break
        sleep(failed.wait if failed.wait is not None else rand() * min(MOST_WAIT, backoff * 2 ** (attempt - 1)))
    return url, None, None, failed.status, None, attempt, str(failed), failed.kind, None, None


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def direct(proxies: dict[str, str] | None = None) -> Send:
    """Sends by urllib; proxies: none, or as urllib names them."""
    opener = urllib.request.build_opener(_Stay, urllib.request.ProxyHandler(proxies or {}))

    def chunks(got, end: float) -> Iterator[bytes]:
        line = getattr(getattr(got.fp, "raw", None), "_sock", None)
        while True:
            if line:  # a wait for more never outlasts the request
                line.settimeout(max(0.001, end - time.monotonic()))
            if not (part := got.read1(1 << 16)):  # what has come, however little
                return
            yield part

    def send(url: str, headers: dict[str, str], timeout: float) -> Reply:
        end = time.monotonic() + timeout
        try:
            got = opener.open(urllib.request.Request(url, headers=headers), timeout=timeout)
        except urllib.error.HTTPError as e:
            got = e
        except urllib.error.URLError as e:
            raise e.reason if isinstance(e.reason, OSError) else OSError(str(e.reason)) from None
        return Reply(got.status, {k.lower(): v for k, v in got.headers.items()}, chunks(got, end), got.close)

    return send


class Pace:
    """Holds each host's requests `seconds` apart, whatever thread sends them."""

    def __init__(self, seconds: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.sleep, self.clock, self.next, self.lock = seconds, sleep, clock, {}, threading.Lock()

    def __call__(self, send: Send) -> Send:
        def paced(url: str, headers: dict[str, str], timeout: float) -> Reply:
            host = urlsplit(url).hostname
            with self.lock:
                now = self.clock()
                at = max(now, self.next.get(host, now))
                self.next[host] = at + self.seconds
            if at > now:
                self.sleep(at - now)  # a wait of our own is no part of the reply's time
            return send(url, headers, timeout)

        return paced


def _ways() -> list[Send]:
    proxies = {k: v for k, v in urllib.request.getproxies().items() if k in ("http", "https")}
    return [direct(), direct(proxies)] if proxies else [direct()]


def fetched(
    rows: DataFrame, ways: Callable[[], list[Send]] = _ways, addresses=addresses_of, headers: dict[str, str] | None = None, timeout: float = TIMEOUT, retries: int = RETRIES, sleep=time.sleep,
    known: DataFrame | None = None, tasks: int | None = None, flight: int = FLIGHT, pace: float = PACE,
) -> DataFrame:
    """FETCHED of the urls of rows, each once. kind and error tell why there is no body: network, timeout, rate_limit,
    upstream, permanent_http or security. Null urls are left out; text.decode_body makes texts of bodies.

    known: url, etag, last_modified of earlier fetches, asked for conditionally (304 and no body where nothing changed).
    tasks: how many share the hosts (else twice the cores). flight: requests under way in a task; pace: seconds between
    two to one host. A host of very many urls takes its time, since it is one task's; others' tasks don't wait for it."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold = Pace(pace, sleep)
        sends = [hold(send) for send in ways()]
        names = [c.split()[0] for c in FETCHED.split(", ")]

        def ask(row) -> tuple:
            told = {k: v for k, v in (("if-none-match", row.etag), ("if-modified-since", row.last_modified)) if isinstance(v, str) and v}
            return one(row.url, sends, addresses, (headers or {}) | told, timeout, retries, sleep=sleep)

        with ThreadPoolExecutor(flight) as pool:
            each = (row for pdf in parts for row in pdf.itertuples(index=False))
            once = (next(same) for _, same in itertools.groupby(each, key=lambda r: r.url))
            while some := list(itertools.islice(once, 4 * flight)):
                for got in pool.map(ask, some):  # a row a batch: a body may have megabytes
                    yield pd.DataFrame([got], columns=names).astype({"status": "Int32"})

    spark = rows.sparkSession
    wanted = rows.select("url").where("url is not null")
    if known is None:
        wanted = wanted.select("url", F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    else:
        latest = known.where("url is not null").groupBy("url").agg(F.max(F.struct("etag", "last_modified")).alias("v")).select("url", "v.etag", "v.last_modified")
        wanted = wanted.join(latest, "url", "left")
    # a number of partitions that is named isn't coalesced; hosts alternate within a task, and a url's repeats lie together
    dealt = wanted.repartition(tasks or 2 * spark.sparkContext.defaultParallelism, F.coalesce(urls.host(F.col("url")), F.col("url")))
    return dealt.sortWithinPartitions(F.xxhash64("url"), "url").mapInPandas(run, FETCHED)
