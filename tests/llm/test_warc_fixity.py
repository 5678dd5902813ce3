import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sigweave.llm import warc_fixity

SCHEMA = "page_id long, url string, html string, archive string, node string, digest string"


def pages(spark, n):
    rng = random.Random(n)
    rows = [(i, f"http://h/{i % 7}", "".join(rng.choices("<p>ab c\né", k=rng.randint(0, 300)))) for i in range(n)]
    rows += [(3, "http://h/3", "again"), (3, "http://h/3", "again"), (None, None, None), (5000, "u", None), (5001, None, ""), (5002, "u", "x" * 200_000)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4), rows


def warc(i, url, html):
    body = (html or "").encode()
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize(("fanout", "n"), [(16, 300), (4, 300), (2, 40)])
def test_finds_what_differs(spark, monkeypatch, fanout, n):
    monkeypatch.setattr(warc_fixity, "FANOUT", fanout)
    frame, rows = pages(spark, n)
    damaged = F.when(F.col("page_id") % 37 == 5, F.concat(F.lit("#"), F.substring("html", 2, 10**6))).otherwise(F.col("html"))
    got = warc_fixity.audit(warc_fixity.layout(frame, damaged)).collect()
    assert len(got) == len(set(rows)) and sum(r.copies for r in got) == len(rows)
    assert all((r.status == "corrupt") == (r.sha256 != r.replica_sha256) for r in got)
    assert {r.page_id for r in got if r.status == "corrupt"} >= {5, 42} if n > 42 else True
    by = {hashlib.sha256(warc(*r)).hexdigest(): len(warc(*r)) for r in rows}
    assert {r.sha256: r.length for r in got} == by
    archives = {}
    for r in sorted(got, key=lambda r: (r.archive, r.seq)):
        at, seq = archives.get(r.archive, (0, 0))
        assert (r.offset, r.seq) == (at, seq) and r.seq < fanout**3
        archives[r.archive] = (at + r.length, seq + 1)
    assert sorted(archives) == list(range(-(-len(got) // fanout**3)))
    ids = [r.page_id for r in sorted(got, key=lambda r: (r.archive, r.seq))]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_same_replicas_stop_at_the_roots(spark):
    frame, _ = pages(spark, 100)
    leaves = warc_fixity.layout(frame)
    one, two = warc_fixity.nodes(leaves, "sha256"), warc_fixity.nodes(leaves, "replica_sha256")
    assert warc_fixity.corrupt(one, two).count() == 0
    assert one[-1].count() == 1


def test_empty(spark):
    assert warc_fixity.audit(warc_fixity.layout(spark.createDataFrame([], SCHEMA))).count() == 0


def laid(rows, archive):
    """archive to the list of (id, url, sha, seq, offset) of its records in order."""
    out = {}
    for n, (i, u, h) in enumerate(sorted(rows)):
        part = out.setdefault(archive(n, i), [])
        at = part[-1][4] + part[-1][5] if part else 0
        part.append((i, u, hashlib.sha256(warc(i, u, h)).hexdigest(), len(part), at, len(warc(i, u, h))))
    return out


def brute(rows, other, archive):
    """Of records with one id each."""
    mine, theirs = laid(rows, archive), laid(other, archive)
    out = {}
    for a in {*mine, *theirs}:
        x, y = ({r[:2]: r for r in side.get(a, [])} for side in (mine, theirs))
        for k in {*x, *y}:
            m, t = x.get(k), y.get(k)
            out[a, *k] = "missing" if t is None else "extra" if m is None else "corrupt" if m[2] != t[2] else "ok" if m == t else "moved"
    return out


@pytest.mark.parametrize("named", [False, True])
def test_replica_of_its_own_layout(spark, monkeypatch, named):
    monkeypatch.setattr(warc_fixity, "FANOUT", 4)
    rows = [(i, f"http://h/{i}", f"body {i} " + "x" * (i % 7)) for i in range(150)]
    frame = lambda r: spark.createDataFrame(r, "page_id long, url string, html string").repartition(3)
    cases = {
        "same": rows,
        "truncated": [(i, u, h[:3] if i == 140 else h) for i, u, h in rows],
        "changed": [(i, u, "#" + h[1:] if i == 70 else h) for i, u, h in rows],
        "missing": [r for r in rows if r[0] != 45],
        "several": [(i, u, "#" + h[1:] if i == 49 else h) for i, u, h in rows if i not in (45, 46, 148)] + [(47, "u", "more")],
        "archives lost": rows[:60],
        "extra": [*rows, (150, "u", "more"), (151, "u", "more")],
        "none": [],
    }
    archive = (lambda n, i: i // 50) if named else (lambda n, i: n // 64)
    lay = lambda r: warc_fixity.layout(frame(r), archive=F.floor(F.col("page_id") / 50) if named else None)
    mine = lay(rows)
    for name, other in cases.items():
        got = warc_fixity.audit(mine, lay(other)).collect()
        want = brute(rows, other, archive)
        assert {(r.archive, r.page_id, r.url): r.status for r in got} == want and len(got) == len(want), name
        assert (set(want.values()) == {"ok"}) == (name == "same")
        assert all((r.seq is None) == (r.status == "extra") and (r.replica_seq is None) == (r.status == "missing") for r in got)


def test_large_archive_and_awkward_records(spark, monkeypatch):
    """An archive of more records than a tree has leaves, records without id, several of one id, line ends in a url."""
    monkeypatch.setattr(warc_fixity, "FANOUT", 2)
    rows = [(i, "u", f"b{i}") for i in range(40)] + [(None, "u\r\nX: y", "z"), (None, None, None), (7, "u", "other"), (7, "u", "third"), (7, "u", "third")]
    frame = lambda r: warc_fixity.layout(spark.createDataFrame(r, "page_id long, url string, html string").repartition(5), archive=F.lit(3))
    same = warc_fixity.audit(frame(rows), frame(rows)).collect()
    assert len(same) == 44 and {r.status for r in same} == {"ok"} and sum(r.copies for r in same) == 45
    changed = [(7, "u", "thirD") if r == (7, "u", "third") else (None, None, "new") if r == (None, None, None) else r for r in rows]
    got = [r for r in warc_fixity.audit(frame(rows), frame(changed)).collect() if r.status in ("corrupt", "missing", "extra")]
    assert {(r.page_id, r.url) for r in got} == {(7, "u"), (None, None)} and len(got) <= 3
    assert hashlib.sha256(warc(None, "u\r\nX: y", "z")).hexdigest() in {r.sha256 for r in same}


def test_one_root_whatever_the_size(spark):
    """An archive of 9,000 records beside one of a single record: one root each, and a root that is equal ends the search."""
    rows = spark.range(9001).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("body "), "id").alias("html"))
    lay = lambda r: warc_fixity.layout(r, archive=F.when(F.col("page_id") == 9000, 2).otherwise(1))
    leaves = lay(rows)
    top = warc_fixity.nodes(leaves, "sha256")[-1].collect()
    assert sorted((r.archive, r.node) for r in top) == [(1, 0), (2, 0)]
    assert warc_fixity.levels(leaves) == 4 and warc_fixity.levels(leaves.where("archive = 2")) == 1
    changed = lay(rows.withColumn("html", F.when(F.col("page_id").isin(0, 4096, 8999, 9000), F.concat(F.lit("#"), F.substring("html", 2, 99))).otherwise(F.col("html"))))
    got = warc_fixity.audit(leaves, changed)
    assert sorted((r.page_id, r.status) for r in got.where("status <> 'ok'").collect()) == [(i, "corrupt") for i in (0, 4096, 8999, 9000)] and got.count() == 9001
