"""Near-dedup by SimHash blocks at a Jaccard similarity of word shingles, verified on the texts.

Texts with the same set of shingles are one node. A node's SimHash has WIDE bits; two sets at Jaccard s have an angle of
arccos(2 s / (1 + s)) at most, so at 0.8 some 78 of 512 bits differ, with a deviation of 8: pairs of up to `bound` bits are
candidates, unrelated ones differ in 256. BANDS blocks of ROWS bits deal the fingerprints to buckets, and within a bucket
they meet again on further bits, as many as leave about a dozen in company, in as many ways as find nearly all; what
meets is compared on all bits. A pair at 0.8 is missed with probability 2e-6, by calculation, and one above with less.
The nodes of a bucket that candidates connect are a cluster.

Who shares a cluster is compared further, and only a Jaccard similarity of the shingle sets of `least` or more links. In
rounds, the nodes of a cluster are compared with one of them, the pivot, that with the most company in all its clusters: of
copies of one text that is most often the text itself. A cluster with a node that has a better pivot elsewhere waits. A round
is linear; its pivots leave their clusters, and what is linked needs no further comparison within it. After ROUNDS, nodes that still share a cluster with nodes of other components are
compared if they have a shingle in common among their rarest (as many as two sets at `least` need) at places that leave
room for enough more: that loses no pair, and texts that share all but their rare parts make no pairs.

Defined results: null text is empty; texts without words are one node; of each component the row with the smallest
(doc_id, hash of the text) stays, null doc_ids last; of rows that agree in both one stays.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, mix, ranges, slabs, text_of, written
from .components import components
from .simhash import SEED, WIDE, slab_shingles, wide_fingerprints

#: Blocks of a fingerprint, and bits of a block (4 blocks lie in a word of 64).
BANDS, ROWS = 32, 5
#: Fingerprints of a bucket that are held at once. A larger bucket comes in parts: what is within SPREAD bits of the first of
#: its cluster is not carried on, and later parts are compared at so many bits more.
MOST, SPREAD = 1 << 19, 64
#: In a bucket: how many that meet on a key are compared all with all; the share of pairs at `least` that no key brings together.
SMALL, MISSED = 32, 0.03
#: Rounds with a pivot a cluster, at most. Slots of the counts that order shingles.
ROUNDS, SLOTS = 3, 1 << 18
_WORDS = WIDE // 64


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> list[np.ndarray]:
    h, count = slab_shingles(data, bounds, shingle)
    return [np.unique(x) for x in np.split(h, np.cumsum(count)[:-1])]


def differing(least: float) -> float:
    """The share of bits in which two fingerprints differ on average, at most, at a Jaccard similarity of `least`."""
    return math.acos(2 * least / (1 + least)) / math.pi


def bound(least: float) -> int:
    """The bits in which two fingerprints at `least` differ, at most: 5.2 deviations above the average."""
    p = differing(least)
    return int(WIDE * p + 5.2 * math.sqrt(WIDE * p * (1 - p)))


def signatures(rows: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th, text to doc_id, th, node (a hash of the shingle set), fp (null for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            sets = shingle_sets(slab.data, slab.bounds, shingle)
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
            size = np.array([len(s) for s in sets])
            fp = wide_fingerprints(np.concatenate(sets), size)[size > 0]
            at = np.append(0, np.cumsum((size > 0) * _WORDS))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32(), mask=np.append(size == 0, False)), pa.array(fp.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id").cast(pa.int64()), slab.rows.column("th").cast(pa.int64()), pa.array(node.view(np.int64)), lists], names=["doc_id", "th", "node", "fp"])

    return rows.mapInArrow(run, "doc_id long, th long, node long, fp array<long>")


def _apart(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the rows i and j of fp differ."""
    out = np.zeros(len(i), np.int64)
    for a in range(0, len(i), 1 << 16):
        out[a : a + (1 << 16)] = np.bitwise_count(fp[i[a : a + (1 << 16)]] ^ fp[j[a : a + (1 << 16)]]).sum(axis=1)
    return out


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives what the pairs i, j connect its smallest label; a label is the place of a row that has it."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _merge_large(fp: np.ndarray, label: np.ndarray, left: np.ndarray, most: int) -> None:
    """Connects the rows `left` at `most` differing bits or fewer: each with what the rows reached last reach."""
    while len(left) > 1:
        front, rest = left[:1], left[1:]
        while len(front) and len(rest):
            same = label[rest] == label[left[0]]
            front, rest = np.concatenate([front, rest[same]]), rest[~same]
            near, step = np.zeros(len(rest), bool), max(1, (1 << 16) // max(1, len(rest)))
            for a in range(0, len(front), step):
                part = front[a : a + step]
                near |= (_apart(fp, np.repeat(rest, len(part)), np.tile(part, len(rest))) <= most).reshape(len(rest), len(part)).any(axis=1)
            front, rest = rest[near], rest[~near]
            _merge(label, front, np.full(len(front), left[0]))
        left = rest


def bucket_labels(fp: np.ndarray, bits: np.ndarray, share: float, most: int) -> np.ndarray:
    """Labels of the fingerprints that pairs at `most` differing bits or fewer connect. Pairs meet on keys of some of the
    `bits` (places, in the order of use); share: in which part of their bits those at the similarity sought differ."""
    n = len(fp)
    label = np.arange(n)
    width = max(0, n.bit_length() - 4)
    keys = math.ceil(math.log(MISSED) / math.log(1 - (1 - share) ** width)) if width else 1
    for k in range(keys):
        key = np.zeros(n, np.int64)
        for b in np.take(bits, np.arange(k * width, (k + 1) * width), mode="wrap"):
            key = key << 1 | (fp[:, b >> 6] >> np.uint64(b & 63) & np.uint64(1)).astype(np.int64)
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[by], prepend=-1))
        size = np.diff(first, append=n)
        end = np.repeat(first + size, size)
        follow = np.where(np.repeat(size, size) <= SMALL, end - np.arange(n) - 1, np.minimum(1, end - np.arange(n) - 1))
        for a in range(0, n, 1 << 16):  # some pairs at a time
            count = follow[a : a + (1 << 16)]
            i = np.repeat(np.arange(a, a + len(count)), count)
            i, j = by[i], by[i + 1 + ranges(count)]
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]
            close = _apart(fp, i, j) <= most
            _merge(label, i[close], j[close])
        for a, c in zip(first[size > SMALL], size[size > SMALL], strict=True):
            _merge_large(fp, label, by[a : a + c], most)
    return label


def _by_bucket(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """bucket, nodes, fingerprints of batches that come bucket by bucket, in parts of about `most` rows; whether more may come."""
    now, parts, held = None, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, node = (batch.column(c).to_numpy() for c in (0, 1))
        fp = batch.column(2).flatten().to_numpy().view(np.uint64).reshape(-1, _WORDS)
        for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]):
            if parts and (bucket[a] != now or held >= most):
                yield now, *(np.concatenate(x) for x in zip(*parts, strict=True)), bucket[a] == now
                parts, held = [], 0
            now = int(bucket[a])
            parts.append((node[a:b], fp[a:b]))
            held += b - a
    if parts:
        yield now, *(np.concatenate(x) for x in zip(*parts, strict=True)), False


def clusters(nodes: DataFrame, least: float) -> DataFrame:
    """node, fp to key, node: the clusters of two nodes or more in all buckets."""
    rows, most_held, spread, share, most = ROWS, MOST, SPREAD, differing(least), bound(least)
    block = F.array(*[F.lit(t << rows) + F.shiftright(F.col("fp")[t % _WORDS], t // _WORDS * rows).bitwiseAND((1 << rows) - 1).cast("int") for t in range(BANDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, held = None, None
        for bucket, node, fp, more in _by_bucket(batches, most_held):
            head, known = node, np.zeros(len(node), bool)
            if carried == bucket:
                node, fp, head, known = (np.concatenate(x) for x in zip(held, (node, fp, head, known), strict=True))
            t = bucket >> rows
            used = [t % _WORDS * 64 + t // _WORDS * rows + r for r in range(rows)]
            bits = np.random.default_rng(t).permutation(np.setdiff1d(np.arange(WIDE), used))
            label = bucket_labels(fp, bits, share, most + spread * (carried == bucket))
            inside = np.bincount(label, minlength=len(node))[label] > 1
            of = head[label]
            new, moved = inside & ~known, known & (head != of)
            salt = mix(np.array([bucket + 1]))
            key, was = (mix(x.view(np.uint64) ^ salt).view(np.int64) for x in (of, head))
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(node[new]), pa.nulls(new.sum(), pa.int64())], names=["key", "node", "other"])
            if moved.any():  # clusters of earlier parts that this one connects
                yield pa.RecordBatch.from_arrays([pa.array(key[moved]), pa.array(node[moved]), pa.array(was[moved])], names=["key", "node", "other"])
            carried = bucket if more else None
            if more:
                keep = (label == np.arange(len(node))) | (_apart(fp, label, np.arange(len(node))) > spread)
                held = node[keep], fp[keep], of[keep], (known | inside)[keep]

    dealt = nodes.where("fp is not null").select(F.explode(block).alias("bucket"), "node", "fp")
    found = written(dealt.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "key long, node long, other long"), "clusters")
    out, same = found.where("other is null").select("key", "node"), found.where("other is not null")
    if same.isEmpty():
        return out
    roots = written(components(same.select(F.col("key").alias("u"), F.col("other").alias("v"))).toDF("key", "root"), "same")
    return out.join(roots, "key", "left").select(F.coalesce("root", "key").alias("key"), "node")


def similar(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs u, v of nodes at a Jaccard similarity of `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(iter([batch]), "left"):
                right = pa.RecordBatch.from_arrays([slab.rows.column("right")], names=["right"])
                other = [s for part in slabs(iter([right]), "right") for s in shingle_sets(part.data, part.bounds, shingle)]
                good = []
                for x, y in zip(shingle_sets(slab.data, slab.bounds, shingle), other, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both >= least * (len(x) + len(y) - both))
                yield slab.rows.select(["u", "v"]).filter(pa.array(good))

    left = texts.select(F.col("node").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("right"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right").mapInArrow(run, "u long, v long")


def _mixed(placed: DataFrame) -> DataFrame:
    """Of key, node, root what is in clusters of several roots."""
    keys = written(placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"), "mixed")
    return written(placed.join(keys, "key"), "open")


def _slots(h: np.ndarray, slots: int) -> np.ndarray:
    return (mix(h) & np.uint64(slots - 1)).astype(np.int64)


def _prefixes(nodes: DataFrame, shingle: int, least: float) -> DataFrame:
    """Of node, root, text: size of the set, and the rarest shingles of it, so many that two sets at `least` or more have
    one of these in common; at: its place in the set's order. Any one order of all shingles will do; this one goes by
    counts in SLOTS slots, which are so many numbers whatever the input."""

    slots = SLOTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for slab in slabs(batches, "text"):
            for x in shingle_sets(slab.data, slab.bounds, shingle):
                np.add.at(total, _slots(x, slots), 1)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "n"])

    counts = np.zeros(slots, np.int64)
    for r in nodes.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # SLOTS rows at most
        counts[r["slot"]] = r["n"]
    sent = nodes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for slab in slabs(batches, "text"):
            row, size, at, token = [], [], [], []
            for i, x in enumerate(shingle_sets(slab.data, slab.bounds, shingle)):
                often = known[_slots(x, slots)]
                first = np.lexsort((x, often))[: len(x) - int(np.ceil(least * len(x) - 1e-9)) + 1]
                place = np.flatnonzero(often[first] > 1)  # no other set has the rest
                row.append(np.full(len(place), i))
                size.append(np.full(len(place), len(x)))
                at.append(place)
                token.append(x[first[place]].view(np.int64))
            row, size, at, token = (np.concatenate(y) for y in (row, size, at, token))
            yield pa.RecordBatch.from_arrays([*[slab.rows.column(c).take(pa.array(row)) for c in ("node", "root")], pa.array(size), pa.array(at), pa.array(token, pa.int64())], names=["node", "root", "size", "at", "token"])

    return nodes.mapInArrow(run, "node long, root long, size long, at long, token long")


def _by_prefix(nodes: DataFrame, shingle: int, least: float) -> DataFrame:
    """u, v: all nodes of different roots that may be at `least` or more, by prefix and place (Xiao et al., 2008)."""
    mine = written(_prefixes(nodes, shingle, least), "prefixes")
    known = mine.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    mine = written(mine.join(written(known, "tokens"), "token"), "prefixes")
    other = mine.select("token", F.col("node").alias("v"), F.col("root").alias("other"), F.col("size").alias("size_v"), F.col("at").alias("at_v"))
    enough = F.least(F.col("size") - F.col("at"), F.col("size_v") - F.col("at_v")) >= least / (1 + least) * (F.col("size") + F.col("size_v")) - 1e-6
    alike = mine.join(other, "token").where((F.col("node") < F.col("v")) & (F.col("root") != F.col("other")) & enough)
    return alike.select(F.col("node").alias("u"), "v").distinct()


def _around_pivots(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each cluster's pivot, the node with the most company in all its clusters, with the nodes of other roots there; and
    the clusters without their pivots. A cluster waits as it is while one of its nodes is in a cluster of a better pivot."""
    company = placed.groupBy("key").agg(F.count("*").alias("n"))
    company = written(placed.join(written(company, "sizes"), "key").groupBy("node").agg(F.sum("n").alias("company")), "company")
    best = F.max_by(F.struct("node", "root", "company"), F.struct("company", -F.col("node"))).alias("pivot")
    pivots = placed.join(company, "node").groupBy("key").agg(best).select("key", F.col("pivot.node").alias("pivot"), F.col("pivot.root").alias("of"), F.struct("pivot.company", -F.col("pivot.node")).alias("rank"))
    both = written(placed.join(written(pivots, "pivots"), "key"), "around")
    seen = written(both.groupBy("node").agg(F.max("rank").alias("seen")), "seen")
    waits = written(both.join(seen, "node").where("seen > rank").select("key").distinct(), "waits")
    now = both.join(waits, "key", "left_anti")
    stars = now.where("root <> of").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    return stars, now.where("node <> pivot").select("key", "node", "root").union(both.join(waits, "key").select("key", "node", "root"))


def links(nodes: DataFrame, rows: DataFrame, shingle: int, least: float) -> DataFrame:
    """nodes (node, least: its first row, fp) to links u, v that connect what similarity connects."""
    placed = written(clusters(nodes.select("node", "fp"), least).select("key", "node", F.col("node").alias("root")), "shared")
    asked = placed.select("node").distinct().join(nodes.select("node", "least.doc_id", "least.th"), "node")
    asked = asked.select("node", F.col("doc_id").alias("d"), F.col("th").alias("h"))
    # asked and judged grow with docs, so the plans are the same at every size: both sides are dealt by key
    texts = written(rows.join(asked.hint("merge"), (F.col("th") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("node", "text").dropDuplicates(["node"]), "texts")
    found = done = None
    for _ in range(ROUNDS):
        if placed.isEmpty():
            break
        stars, rest = _around_pivots(placed)
        stars = written(stars if done is None else stars.join(done, ["u", "v"], "left_anti"), "stars")
        done = stars if done is None else done.union(stars)
        good = written(similar(stars, texts, shingle, least), "similar")
        found = good if found is None else found.union(good)
        of = placed.select("node", "root").distinct()
        joined = good.join(of.toDF("u", "a"), "u").join(of.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
        roots = written(components(joined).toDF("root", "now"), "roots")
        placed = _mixed(written(rest.join(roots, "root", "left").select("key", "node", F.coalesce("now", "root").alias("root")), "placed"))
    open_ = written(texts.join(placed.select("node", "root").distinct(), "node"), "open")
    pairs = _by_prefix(open_, shingle, least)
    if done is not None:
        pairs = pairs.join(done.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), ["u", "v"], "left_anti")
    good = similar(written(pairs, "pairs"), texts, shingle, least)
    return good if found is None else found.union(good)


def _first() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """docs with one document of each component of those at a similarity of `least` or more."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{column(docs, id_col)}").cast("long"), text_of(f"c{column(docs, text_col)}")
    rows = plain.select(key.alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    signed = written(signatures(rows, shingle), "signatures")
    nodes = written(signed.groupBy("node").agg(F.min(_first()).alias("least"), F.first("fp").alias("fp")), "nodes")
    roots = written(components(links(nodes, rows, shingle, least)), "roots")
    rooted = written(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    kept = written(rooted.groupBy("root").agg(F.min("least").alias("kept")), "kept")
    named = written(rooted.join(kept, "root").select("node", "kept"), "named")
    rows = signed.groupBy("doc_id", "th", "node").agg(F.count("*").alias("n")).join(named, "node").withColumn("lost", _first() != F.col("kept"))
    judged = written(rows.where("lost or n > 1").select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "lost", "n"), "lost")
    out = plain.withColumn("th", F.xxhash64(text)).join(judged.hint("merge"), (F.col("th") == F.col("h")) & key.eqNullSafe(F.col("d")), "left").where("lost is null or not lost")
    if not judged.where("not lost").isEmpty():
        once = out.where("n > 1").dropDuplicates([f"c{column(docs, id_col)}", "th"])
        out = out.where("n is null").unionByName(once)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
