"""Substring dedup by relative Lempel-Ziv parsing against an index of all texts.

The index: every 50-word window is filed under its anchor, the 16-word gram in it with the least hash, so that
equal windows share an anchor wherever they stand, and about one gram in eighteen is an anchor. Documents whose
anchors all are their own need no parsing. Of equal documents one is indexed; its later copies are one factor
each. The windows of the rest are filed by a 128-bit key, which names the earliest document that holds the window, and
where. That place lies in a reference block: BLOCK words of that document, whose text goes to all who ask for it.

The parse is greedy: from the first window that has a reference, the document's words are compared with those of the
reference blocks, and the factor ends where the words part or the reference's run of windows does. At each factor's
end the windows that straddle it are looked up as well. Only factors of 50 words or more count, word by word; those
of earlier documents are removed. A window whose words differ from those that its key names (keys may collide) has
no factor; such windows are matched once more by their whole words, so no hash decides a removal or stops one.

Defined results: null text has no words; a row with null doc_id loses nothing and removes nothing; rows of one
doc_id don't remove each other's words; rows that repeat stay; fewer than 50 words are never removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, pick, ranges, slabs, text_of, written

WINDOW, GRAM, BLOCK = 50, 16, 64
_RNG = np.random.default_rng(977)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_MULTIPLIERS = [int(x) | 1 for x in _RNG.integers(0, 2**64, 2, dtype=np.uint64)]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], the same wherever they stand. Different values may well share one; they
    choose anchors only."""
    n = len(values)
    powers = np.empty(n + 1, np.uint64)
    powers[0] = 1
    powers[1:] = multiplier
    inverse = np.empty(n + 1, np.uint64)
    inverse[0] = 1
    inverse[1:] = pow(multiplier, -1, 1 << 64)
    powers, inverse = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


class Windows:
    """The 50-word windows of a slab: start (word of the slab), row, anchor gram (word of the slab)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.words = words = Words(data, bounds)
        n = len(words.starts)
        counts = np.maximum(np.diff(words.first) - WINDOW + 1, 0)
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.start = np.arange(len(self.row)) - np.repeat(np.cumsum(counts) - counts, counts) + words.first[self.row]
        if not len(self.start):
            self.anchor, self.grams, self.of_words = self.start, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            return
        self.of_words = _spans(_BYTE[data], words.starts, words.ends, _MULTIPLIERS[0]) ^ mix(words.ends - words.starts)
        at = np.arange(n - GRAM + 1)
        self.grams = _spans(self.of_words, at, at + GRAM, _MULTIPLIERS[1])
        low = np.uint64((1 << 28) - 1)
        least = (self.grams & ~low) | at.astype(np.uint64)
        for step in (1, 2, 4, 8, 16, WINDOW - GRAM + 1 - 32):
            least = np.minimum(least[:-step], least[step:])
        self.anchor = (least[self.start] & low).astype(np.int64)


def _shas(whole: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[str]:
    return [hashlib.sha256(whole[starts[a] : ends[b - 1]]).hexdigest() if b > a else _EMPTY for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for slab in slabs(batches, "text"):
        windows = Windows(slab.data, slab.bounds)
        joined, starts, ends = windows.words.joined(slab.data)
        whole, first = joined.tobytes(), windows.words.first
        shas = _shas(whole, starts, ends, first)
        fresh = np.ones(len(windows.start), dtype=bool)
        fresh[1:] = (windows.anchor[1:] != windows.anchor[:-1]) | (windows.row[1:] != windows.row[:-1])
        counts = np.bincount(windows.row[fresh], minlength=len(slab))
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        anchors = pa.ListArray.from_arrays(offsets, pa.array(windows.grams[windows.anchor[fresh]].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [slab.rows.column("doc_id"), slab.rows.column("th"), pa.array(np.diff(first).astype(np.int64)), pa.array(shas, pa.string()), anchors], names=["doc_id", "th", "n_words", "sha", "anchors"]
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose words have the asked hash, with a uid each."""
    part, row = TaskContext.get().partitionId() << 33, 0
    for slab in slabs(batches, "text"):
        words = Words(slab.data, slab.bounds)
        joined, starts, ends = words.joined(slab.data)
        shas = _shas(joined.tobytes(), starts, ends, words.first)
        rows = slab.rows.filter(pa.array([x == y for x, y in zip(shas, slab.rows.column("sha").to_pylist(), strict=True)], pa.bool_()))
        uid = pa.array(part + row + np.arange(rows.num_rows), pa.int64())
        row += rows.num_rows
        yield pa.RecordBatch.from_arrays([uid, *[rows.column(c) for c in ("doc_id", "sha", "text", "anchors")]], names=["uid", "doc_id", "sha", "text", "anchors"])


def _windows(key_bits: int):
    """uid, doc_id, key, at of the windows with an anchor that another document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, mask = xxhash.xxh3_128_intdigest, (1 << key_bits) - 1
        for slab in slabs(batches, "text"):
            windows = Windows(slab.data, slab.bounds)
            if not len(windows.start):
                continue
            joined, starts, ends = windows.words.joined(slab.data)
            whole, names = joined.tobytes(), windows.grams[windows.anchor].view(np.int64)
            keep, edges = np.zeros(len(names), dtype=bool), np.searchsorted(windows.row, np.arange(len(slab) + 1))
            for i, shared in enumerate(slab.rows.column("anchors").to_pylist()):
                a, b = edges[i], edges[i + 1]
                keep[a:b] = np.isin(names[a:b], np.array(shared, np.int64))
            which = np.flatnonzero(keep)
            for lo in range(0, len(which), 100_000):
                part = which[lo : lo + 100_000]
                start, rows = windows.start[part], pa.array(windows.row[part])
                keys = [(digest(whole[a:b]) & mask).to_bytes(16, "little") for a, b in zip(starts[start].tolist(), ends[start + WINDOW - 1].tolist(), strict=True)]
                at = (start - windows.words.first[windows.row[part]]).astype(np.int32)
                halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                columns = [slab.rows.column("uid").take(rows), slab.rows.column("doc_id").take(rows), *[pa.array(halves[:, i].copy()) for i in (0, 1)], pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "k1", "k2", "at"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's windows with their places in earlier texts, as runs that go on in one text: uid, at, n, ref, ref_at,
    and the blocks that hold the run's words there."""
    for batch in batches:
        hits = batch.column("hits")
        uid = np.repeat(batch.column("uid").to_numpy(), np.diff(hits.offsets.to_numpy()))
        flat = hits.flatten()
        at, ref, ref_at = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "ref", "ref_at"))
        order = np.lexsort((at, uid))
        uid, at, ref, ref_at = uid[order], at[order], ref[order], ref_at[order]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (np.diff(uid) != 0) | (np.diff(at) != 1) | (np.diff(ref) != 0) | (np.diff(ref_at) != 1)
        first = np.flatnonzero(fresh)
        n = np.diff(np.append(first, len(at)))
        low, high = ref_at[first] // BLOCK, (ref_at[first] + n + WINDOW - 2) // BLOCK
        many = high - low + 1
        columns = [np.repeat(x, many) for x in (uid[first], at[first], n, ref[first], ref_at[first])] + [np.repeat(low, many) + ranges(many)]
        out = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["uid", "at", "n", "ref", "ref_at", "block"])
        for lo in range(0, out.num_rows, 100_000):
            yield out.slice(lo, 100_000)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted blocks of each text: ref, block, said (its words with a space between)."""
    for slab in slabs(batches, "text"):
        words = Words(slab.data, slab.bounds)
        joined, starts, ends = words.joined(slab.data)
        whole, refs, numbers, said = joined.tobytes(), [], [], []
        for uid, wanted, a, b in zip(slab.rows.column("uid").to_pylist(), slab.rows.column("wanted").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            for k in wanted:
                lo, hi = a + k * BLOCK, min(a + (k + 1) * BLOCK, b)
                refs.append(uid)
                numbers.append(k)
                said.append(whole[starts[lo] : ends[hi - 1]])
        yield pa.RecordBatch.from_arrays([pa.array(refs, pa.int64()), pa.array(numbers, pa.int64()), pa.array(said, pa.binary())], names=["ref", "block", "said"])


def parse(words: list[bytes], runs: list[tuple[int, int, list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Runs (first window, windows, the words that the reference has there) to factors as word spans, greedily, and the
    windows that are no factor although their key says so."""
    factors, odd = [], []
    for at, n, said in sorted(runs):
        to = at + n + WINDOW - 1
        while at + WINDOW <= to:
            mine = words[at:to]
            theirs = said[len(said) - len(mine) :]
            same = len(mine) if mine == theirs else next(i for i, (x, y) in enumerate(zip(mine, theirs, strict=True)) if x != y)
            if same >= WINDOW:
                factors.append((at, at + same))
                at += same - WINDOW + 1  # the windows that straddle the factor's end are looked up next
            else:
                odd.append(at)
                at += 1
    return factors, odd


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for slab in slabs(batches, "text"):
        words = Words(slab.data, slab.bounds)
        joined, starts, ends = words.joined(slab.data)
        whole, lost, shas, odds, extras = joined.tobytes(), [], [], [], slab.rows.column("extra").to_pylist()
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            mine = whole[starts[a] : ends[b - 1]].split(b" ") if b > a else []
            keep, blocks = np.ones(len(mine), dtype=bool), {}
            for p in slab.rows.column("parts")[i].as_py() or []:
                blocks.setdefault((p["at"], p["n"], p["ref_at"]), []).append((p["block"], p["said"]))
            runs = []
            for (at, n, ref_at), said in blocks.items():
                there = b" ".join([x for _, x in sorted(said)]).split(b" ")
                skip = ref_at % BLOCK
                runs.append((at, n, there[skip : skip + n + WINDOW - 1]))
            factors, odd = parse(mine, runs)
            for lo, hi in [*factors, *[(x, x + WINDOW) for x in extras[i] or []]]:
                keep[lo:hi] = False
            lost.append(len(mine) - int(keep.sum()))
            shas.append(hashlib.sha256(b" ".join([mine[j] for j in np.flatnonzero(keep).tolist()])).hexdigest())
            odds.append(odd)
        yield pa.RecordBatch.from_arrays(
            [slab.rows.column("uid"), slab.rows.column("doc_id"), slab.rows.column("sha"), pa.array(lost, pa.int64()), pa.array(shas, pa.string()), pa.array(odds, pa.list_(pa.int32()))],
            names=["uid", "doc_id", "sha", "n_removed", "kept_sha256", "odd"],
        )


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the windows at `ats`."""
    for slab in slabs(batches, "text"):
        words = Words(slab.data, slab.bounds)
        joined, starts, ends = words.joined(slab.data)
        whole = joined.tobytes()
        for i, ats in enumerate(slab.rows.column("ats").to_pylist()):
            first, n = int(words.first[i]), len(ats)
            columns = [pa.array([int(slab.rows.column(c)[i].as_py())] * n, pa.int64()) for c in ("uid", "doc_id")]
            said = pa.array([whole[starts[first + x] : ends[first + x + WINDOW - 1]] for x in ats], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ats, pa.int32()), said], names=["uid", "doc_id", "at", "said"])


def _parsed(texts: DataFrame, parts: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    rows = texts.select("uid", "doc_id", "sha", "text").join(parts, "uid")
    rows = rows.withColumn("extra", F.lit(None).cast("array<int>")) if extra is None else rows.join(extra, "uid", "left")
    return written(rows.mapInArrow(_cut, "uid long, doc_id long, sha string, n_removed long, kept_sha256 string, odd array<int>"), "removed")


def _removed(texts: DataFrame, key_bits: int) -> DataFrame:
    """doc_id, sha, n_removed, kept_sha256 of the texts that lose words."""
    windows = written(texts.mapInArrow(_windows(key_bits), "uid long, doc_id long, k1 long, k2 long, at int"), "windows")
    first = windows.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "uid", "at")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last")
    first = written(first.select("k1", "k2", F.col("first.doc_id").alias("ref_doc"), F.col("first.uid").alias("ref"), F.col("first.at").alias("ref_at")), "first-windows")
    hits = windows.join(first, ["k1", "k2"]).where("doc_id > ref_doc").groupBy("uid").agg(F.collect_list(F.struct("at", "ref", "ref_at")).alias("hits"))
    runs = written(hits.mapInArrow(_runs, "uid long, at long, n long, ref long, ref_at long, block long"), "runs")
    asked = written(runs.select("ref", "block").distinct().groupBy("ref").agg(F.collect_list("block").alias("wanted")), "asked")
    blocks = texts.select("uid", "text").join(asked, F.col("uid") == F.col("ref")).select("uid", "text", "wanted")
    blocks = written(blocks.mapInArrow(_blocks, "ref long, block long, said binary"), "blocks")
    parts = runs.join(blocks, ["ref", "block"]).groupBy("uid").agg(F.collect_list(F.struct("at", "n", "ref_at", "block", "said")).alias("parts"))
    removed = _parsed(texts, parts)
    odd = removed.select("uid", F.explode("odd").alias("at"))
    if not odd.isEmpty():  # keys that stand for different words: all their windows again, by the words themselves
        keys = written(windows.join(odd, ["uid", "at"]).select("k1", "k2").distinct(), "odd-keys")
        again = written(windows.join(keys, ["k1", "k2"]).groupBy("uid").agg(F.collect_set("at").alias("ats")), "odd-windows")
        said = written(texts.select("uid", "doc_id", "text").join(again, "uid").mapInArrow(_said, "uid long, doc_id long, at int, said binary"), "odd-words")
        least = written(said.groupBy("said").agg(F.min("doc_id").alias("ref_doc"), F.max("doc_id").alias("last")).where("ref_doc < last"), "odd-first")
        extra = written(said.join(least, "said").where("doc_id > ref_doc").groupBy("uid").agg(F.collect_set("at").alias("extra")), "extra")
        lost = written(parts.select("uid").union(extra.select("uid")).distinct().join(parts, "uid", "left"), "parts")
        removed = _parsed(texts, lost, extra)
    return removed.groupBy("doc_id", "sha").agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept_sha256"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 128) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row. key_bits: fewer make keys collide, for tests."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), "text")
    index = written(rows.mapInArrow(_index, "doc_id long, th long, n_words long, sha string, anchors array<long>"), "index")
    known = index.where(f"doc_id is not null and n_words >= {WINDOW}")
    first = written(known.groupBy("sha").agg(F.min(F.struct("doc_id", "th")).alias("first")).select("sha", "first.*"), "first")
    anchors = known.select("doc_id", "th", "sha", "anchors").join(first, ["doc_id", "th", "sha"], "left_semi")
    names = written(anchors.select("doc_id", "th", "sha", F.explode("anchors").alias("anchor")), "anchors")
    shared = written(names.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor"), "shared")
    wanted = written(names.join(shared, "anchor").groupBy("doc_id", "th", "sha").agg(F.collect_set("anchor").alias("anchors")), "wanted")
    texts = rows.join(wanted, ["doc_id", "th"]).select("doc_id", "sha", "text", "anchors")
    texts = written(texts.mapInArrow(_texts, "uid long, doc_id long, sha string, text string, anchors array<long>"), "texts")
    removed = written(_removed(texts, key_bits), "cut")
    first = first.select("sha", F.col("doc_id").alias("first_id"))
    rest = index.select("doc_id", "n_words", "sha").join(first, "sha", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))
    return written(rest, "rest").join(removed, ["doc_id", "sha"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
