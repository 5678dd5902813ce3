"""SimHash near-dedup by pigeonhole blocks.

A fingerprint of 64 bits is split into 2k blocks. Two fingerprints at k or fewer differing bits agree in k
blocks at least, so each combination of k blocks is a key of about 32 bits on which candidates meet (k = 2:
6 keys, k = 3: 20). Equal fingerprints are one node before that. Within a key's bucket the links are found by
comparing bits, and a spanning forest of them goes on, not all pairs. A bucket above `bucket_max` is not
compared in one task: each of its fingerprints instead gives a key for every choice of k masked bits, and
those who meet there differ in these bits alone, so a group has 2**k members at most. No link is lost.

Defined results: null text is empty; a text without words has fingerprint zero and links like any other;
component_id is the smallest non-null doc_id that can be reached (null if there is none); rows that repeat stay.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, column, mix, pick, ranges, slabs, text_of, written
from .components import components

BUCKET_MAX = 4096
SEED = 42
#: Of wide fingerprints: bits; signed classes of shingles, and how many of these a shingle has.
WIDE, CLASSES, OF = 512, 2048, 4


def slab_shingles(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles, row after row, and how many each row has."""
    words = Words(data, bounds)
    joined, starts, ends = words.joined(data)
    lower = joined.tobytes().lower()  # bytes.lower() changes A-Z only
    n = np.diff(words.first)
    count = np.where(n >= shingle, n - shingle + 1, n > 0)
    first = np.repeat(words.first[:-1], count) + ranges(count)
    last = np.minimum(first + shingle - 1, np.repeat(words.first[1:], count) - 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(lower[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), "<u8", len(first)), count


def slab_fingerprints(data: np.ndarray, bounds: np.ndarray, shingle: int) -> np.ndarray:
    h, count = slab_shingles(data, bounds, shingle)
    out = np.zeros((len(count), 64), np.uint8)
    full = np.flatnonzero(count)
    if len(full):
        sums = np.zeros((len(full), 64), np.int64)
        at = (np.cumsum(count) - count)[full]
        for lo in range(0, len(full), 256):  # a few rows at a time: 64 bytes a shingle
            hi = min(lo + 256, len(full))
            a, b = at[lo], at[hi] if hi < len(full) else len(h)
            for c in range(a, b, 1 << 17):
                d = min(c + (1 << 17), b)
                bits = np.unpackbits(h[c:d].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                inside = np.flatnonzero((at[lo:hi] < d) & (at[lo:hi] + count[full[lo:hi]] > c)) + lo
                sums[inside] += np.add.reduceat(bits, np.maximum(at[inside] - c, 0), axis=0, dtype=np.int64)
        out[full] = sums * 2 > count[full][:, None]
    return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


@functools.cache
def _normals() -> np.ndarray:
    """A normal of each hyperplane by class. Small whole numbers: their sums are exact, whatever the order."""
    return np.rint(16 * np.random.default_rng(SEED).standard_normal((CLASSES, WIDE))).astype(np.float32)


def wide_fingerprints(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A row of WIDE bits for each run of shingle hashes: on which sides of random hyperplanes (Charikar, 2002) the sum of
    its shingles' vectors lies. Two runs differ in a bit with the probability of their angle over pi. A shingle's vector
    is the signed sum of the normals of OF classes, so a row of counts by class times the normals is all it takes."""
    out = np.zeros((len(count), WIDE // 64), np.uint64)
    x, ends = mix(h), np.cumsum(count)
    each, step = 64 // OF, 256
    for lo in range(0, len(count), step):
        part = count[lo : lo + step]
        y = x[ends[lo] - count[lo] : ends[lo + len(part) - 1]]
        row, sums = np.repeat(np.arange(len(part)) * CLASSES, part), np.zeros(len(part) * CLASSES)
        for shift in range(0, 64, each):
            z = (y >> np.uint64(shift)).astype(np.int64)
            sums += np.bincount(row + (z & (CLASSES - 1)), 1.0 - 2 * (z >> (each - 1) & 1), len(sums))
        sides = sums.reshape(len(part), CLASSES).astype(np.float32) @ _normals() > 0
        out[lo : lo + step] = np.packbits(sides, axis=1, bitorder="little").view("<u8")
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long, of every row and whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            fp = slab_fingerprints(slab.data, slab.bounds, shingle)
            yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(bits: int) -> list[int]:
    """For k differing bits: the masks of every k of 2k blocks. For 0: all bits."""
    if not bits:
        return [(1 << 64) - 1]
    edges = [round(64 * i / (2 * bits)) for i in range(2 * bits + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(blocks, bits)]


def _forest(bits: int):
    """Stars of the linked members of each bucket around their smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for members in batch.column("members"):
                left = np.sort(np.array(members.as_py(), np.int64))
                while len(left) > 1:
                    root, rest, front = left[0], left[1:], left[:1]
                    while len(front) and len(rest):
                        near = np.zeros(len(rest), dtype=bool)
                        for part in range(0, len(front), 64):
                            near |= (np.bitwise_count(rest[:, None].view(np.uint64) ^ front[None, part : part + 64].view(np.uint64)) <= bits).any(axis=1)
                        front, rest = rest[near], rest[~near]
                        us.append(front)
                        vs.append(np.full(len(front), root))
                    left = rest
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return run


def links(distinct: DataFrame, bits: int, bucket_max: int = BUCKET_MAX) -> DataFrame:
    """Distinct fingerprints (fp) to links u, v that connect what `bits` or fewer differing bits connect."""
    masks = block_masks(bits)
    if math.comb(64 - min(m.bit_count() for m in masks), bits) > 6000:  # whatever the data: a large bucket may come
        raise ValueError(f"{bits} bits are too many for buckets above {bucket_max}")
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("b", "key"))
    sizes = written(keyed.groupBy("b", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = keyed.join(sizes, ["b", "key"])
    members = shared.where(F.col("n") <= bucket_max).groupBy("b", "key").agg(F.collect_list("fp").alias("members"))
    found = members.select("members").mapInArrow(_forest(bits), "u long, v long")
    if sizes.where(F.col("n") > bucket_max).isEmpty():
        return found
    choices = [[signed((1 << 64) - 1 ^ sum(1 << i for i in c)) for c in itertools.combinations([i for i in range(64) if not m >> i & 1], bits)] for m in masks]
    hot = shared.where(F.col("n") > bucket_max)
    cases = F.lit(None).cast("array<bigint>")
    for b, c in enumerate(choices):
        cases = F.when(F.col("b") == b, F.array(*[F.lit(x) for x in c])).otherwise(cases)
    masked = hot.select("fp", "b", F.posexplode(cases).alias("i", "mask")).select("fp", "b", "i", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    cliques = masked.groupBy("b", "i", "key").agg(F.collect_set("fp").alias("members")).where("size(members) > 1")
    return found.union(cliques.select(F.explode("members").alias("u"), F.array_min("members").alias("v")).where("u <> v"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, bits: int = 3, bucket_max: int = BUCKET_MAX) -> DataFrame:
    """doc_id, fp, component_id of every row."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = written(components(links(distinct.select("fp"), bits, bucket_max)), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = written(rooted.join(whole, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")

