"""URL filter on a sorted digest array.

Rules and blocked names become key strings. Their 64-bit xxhash values, sorted, and the strings themselves are
one file, which each executor gets once and memory-maps. Every key that could judge a url is probed by a
vectorised binary search; where a digest is found, the stored string is compared, so a collision decides nothing.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's; the
longest fitting rule decides (by host and path together; then by host). Without a rule, a url is blocked if a
label of its host is a blocked name, or its host or one above it is in the blocklist, else allowed. Defined results: a null url, or one without `://`, has an
empty host and path, no rule, and is allowed; rows that repeat stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, sent_file

#: The rules of production.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Host labels that are blocked without a rule.
BLOCKED = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

#: Different hosts that a blocklist may have: about 1 GB on the driver.
MOST = 5_000_000

_maps: dict[str, "DigestArray"] = {}


def _digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode())


class DigestArray:
    """Keys with a value each, in one file: their number, sorted digests, string offsets, values, strings."""

    def __init__(self, path: str):
        n = int(np.memmap(path, "<i8", "r", 0, 1)[0])
        self.digests = np.memmap(path, "<u8", "r", 8, n) if n else np.zeros(0, "<u8")
        self.offsets = np.memmap(path, "<i8", "r", 8 + 8 * n, n + 1)
        self.values = np.memmap(path, "<i8", "r", 16 + 16 * n, n) if n else np.zeros(0, "<i8")
        self.strings = np.memmap(path, "u1", "r") if n else np.zeros(0, "u1")
        self.base = 16 + 24 * n

    @staticmethod
    def build(keys: dict[str, int], digest=_digest) -> bytes:
        rows = sorted((digest(k), k.encode(), v) for k, v in keys.items())
        ends = np.cumsum([0, *[len(k) for _, k, _ in rows]])
        return b"".join((np.array([len(rows)], "<i8").tobytes(), np.array([d for d, _, _ in rows], "<u8").tobytes(), ends.astype("<i8").tobytes(), np.array([v for _, _, v in rows], "<i8").tobytes(), *[k for _, k, _ in rows]))

    def find(self, keys: list[str], digest=_digest) -> np.ndarray:
        """The value of each key, -1 where it isn't stored."""
        out = np.full(len(keys), -1, np.int64)
        wanted = np.fromiter(map(digest, keys), np.uint64, len(keys))
        first, last = np.searchsorted(self.digests, wanted, "left"), np.searchsorted(self.digests, wanted, "right")
        for i in np.flatnonzero(last > first).tolist():
            key = keys[i].encode()
            for j in range(int(first[i]), int(last[i])):
                a, b = self.base + int(self.offsets[j]), self.base + int(self.offsets[j + 1])
                if self.strings[a:b].tobytes() == key:
                    out[i] = self.values[j]
        return out


def split_url(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.DOTALL).groups()
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] | None = None, blocked: list[str] | None = None, blocklist: DataFrame | None = None, most: int = MOST
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row. rules and blocked are lists on the driver; blocklist is a table of
    hosts (its first column; nulls and empty ones go), of which `most` may be different: the driver holds them once, and
    each executor's disk; a longer one raises an error. None of them grows with the pages."""
    rules, blocked = RULES if rules is None else rules, BLOCKED if blocked is None else blocked
    if bad := [r for r in rules if r[2] not in ("allow", "block")]:
        raise ValueError(f"verdicts must be allow or block: {bad}")
    keys = {f"rule {host}{path}": i for i, (host, path, _) in enumerate(rules)} | {f"name {b}": 0 for b in blocked}
    if blocklist is not None:
        hosts = blocklist.select(F.lower(blocklist.columns[0]).alias("host")).where("host <> ''").distinct()
        if (n := hosts.limit(most + 1).count()) > most:
            raise ValueError(f"the blocklist has {n} hosts or more; `most` allows {most}")
        keys |= {f"host {r['host']}": 0 for r in hosts.toLocalIterator()}
    lengths = sorted({len(path) for _, path, _ in rules})
    # a part of a host can only be known if a key has its length: what is probed grows with a url, not with its square
    ruled, listed, named = {len(host) for host, _, _ in rules}, {len(k) - 5 for k in keys if k.startswith("host ")}, {len(b) for b in blocked}
    longest = max([0, *ruled, *listed])
    content = DigestArray.build(keys)
    name = sent_file(pages.sparkSession, "digests", lambda path: Path(path).write_bytes(content))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _maps:
            _maps[name] = DigestArray(SparkFiles.get(name))
        array = _maps[name]
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            row, size, probes = [], [], []
            for i, (host, path) in enumerate(split):
                if not host:
                    continue
                for label in host.split("."):
                    if len(label) in named:
                        row.append(i)
                        size.append(-1)
                        probes.append(f"name {label}")
                at = len(host)
                while at >= 0 and len(host) - at <= longest:  # from the last label on
                    at = host.rfind(".", 0, at)
                    suffix = host[at + 1 :] if len(host) - at - 1 <= longest else ""
                    if len(suffix) in ruled:
                        for n in lengths:
                            if n <= len(path):
                                row.append(i)
                                size.append((len(suffix) + n) << 32 | len(suffix))
                                probes.append(f"rule {suffix}{path[:n]}")
                    if len(suffix) in listed:
                        row.append(i)
                        size.append(-1)
                        probes.append(f"host {suffix}")
            found = array.find(probes)
            best: dict[int, tuple[int, int]] = {}
            names: set[int] = set()
            for k in np.flatnonzero(found >= 0).tolist():
                if size[k] < 0:
                    names.add(row[k])
                else:
                    best[row[k]] = max(best.get(row[k], (0, 0)), (size[k], int(found[k])))
            hit = [rules[best[i][1]] if i in best else None for i in range(len(split))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([r and r[0] + r[1] for r in hit], pa.string()),
                    pa.array([r[2] if r else "block" if i in names else "allow" for i, r in enumerate(hit)], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    rows = pick(pages, page_id=id_col, url=url_col).select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
