"""Line dedup by a deletion-neighbourhood join.

Lines are compared after collapsing white space. Of lines that are equal, or (from `least` characters on) within
one edit, the earliest stays, by doc_id, then line; it is judged on the input, not on what is left. Blank lines
stay. Equal lines meet by a 128-bit hash first, so that each distinct line is handled once. One edit of a short line
makes another word or number of it, so `least` is 16 by default; any length may be asked for, 1 too.

One edit changes one of s segments, so two such lines share the text outside a segment: s keys a line. Keys
that no other line has end the search for most lines (s = 2 over all, s = 16 over those that are left, with
their text). A line of fewer characters than segments is one segment. What is left emits its deletion variants: the segment
without each of its characters, and whole, hashed with the key, in time linear in the line's length. Lines meet on equal variants: at the same place of deletion they differ by a substitution,
and a whole segment that equals a variant by an insertion. Each line is linked to the earliest line it meets,
never to all, and the edit distance of the pair verifies it.

Defined results: null text is one blank line; rows that repeat are documents each, ordered by their place in
the input; null doc_ids come last; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, slabs, text_of, written

LEAST = 16
COARSE, FINE = 2, 16
#: A prime and a base for the hashes of variants.
_PRIME, _BASE = (1 << 61) - 1, 1_099_511_628_211
_powers = [1]


def normal(line: str) -> str:
    return " ".join(line.split())


def names(line: str) -> tuple[int, int]:
    raw = line.encode("utf-8", "surrogatepass")
    return _signed(xxhash.xxh64_intdigest(raw, 1)), _signed(xxhash.xxh64_intdigest(raw, 2))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(line: str, s: int) -> Iterator[tuple[int, int, int]]:
    """key, start, end: what is outside line[start:end], hashed. Lines within one edit share a key: segment
    lengths come from the length rounded down, and a length that begins a step takes part in the one below."""
    size = len(line)
    units = {_unit(size, s), _unit(size - 1, s)} if _unit(size, s) != _unit(size - 1, s) else {_unit(size, s)}
    for unit in units:
        for i in range(s if unit else 1):
            a, b = i * unit, size - (s - 1 - i) * unit
            outside = f"{s} {unit} {i} {line[:a]}\0{line[b:]}"
            yield _signed(xxhash.xxh64_intdigest(outside.encode("utf-8", "surrogatepass"), 3)), a, b


def _unit(size: int, s: int) -> int:
    step = max(1, (1 << max(size, 1).bit_length() - 1) // 8)
    return size // step * step // s


def variants(line: str, key: int, a: int, b: int) -> Iterator[tuple[int, int]]:
    """hash, place: of the segment without each character, and whole (-1)."""
    m = b - a
    while len(_powers) <= m:
        _powers.append(_powers[-1] * _BASE % _PRIME)
    before = [0]
    for c in line[a:b]:
        before.append((before[-1] * _BASE + ord(c) + 1) % _PRIME)
    whole, digest, name = before[m], xxhash.xxh64_intdigest, key.to_bytes(8, "little", signed=True)
    yield _signed(digest(name + whole.to_bytes(8, "little"), 4)), -1
    for i in range(m):  # what is before it, moved up by what is after it, and what is after it
        body = (whole + (before[i] - before[i + 1]) * _powers[m - 1 - i]) % _PRIME
        yield _signed(digest(name + body.to_bytes(8, "little"), 4)), a + i


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId() << 33, 0
        fields = ["uid", "doc_id", "th", "line", "n_lines", "h1", "h2", "again", "keys"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for slab in slabs(batches, "text"):
            out = []
            for doc_id, th, text in zip(*[slab.rows.column(c).to_pylist() for c in ("doc_id", "th", "text")], strict=True):
                seen: dict[str, list[int]] = {}
                raw = text.split("\n")
                for i, line in enumerate(raw):
                    if body := normal(line):
                        seen.setdefault(body, []).append(i)
                uid = part + row
                row += 1
                out.append((uid, doc_id, th, None, len(raw), None, None, None, None))
                out += [(uid, doc_id, th, at[0], None, *names(x), at[1:], [k for k, _, _ in segments(x, COARSE)] if len(x) >= least else []) for x, at in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=fields)

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each document, with the keys of their fine segments."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            raw = text.split("\n")
            for w in wanted:
                body = normal(raw[w["line"]]) if w["line"] < len(raw) else ""
                if body and names(body) == (w["h1"], w["h2"]):
                    out.append((w["h1"], w["h2"], body, [k for k, _, _ in segments(body, FINE)]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["h1", "h2", "body", "keys"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[int, int, int, int]]:
        for batch in batches:
            for h1, h2, body, keys in zip(*[batch.column(c).to_pylist() for c in ("h1", "h2", "body", "keys")], strict=True):
                wanted = set(keys)
                for key, a, b in segments(body, FINE):
                    if key in wanted:
                        for v, at in variants(body, key, a, b):
                            yield h1, h2, v, at

    made = rows()
    while out := list(itertools.islice(made, 50_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["h1", "h2", "v", "at"])


def within_one(a: str, b: str) -> bool:
    """Whether one edit at most makes a of b. Slices are compared, so that the time is that of a few passes over them."""
    low, high = 0, min(len(a), len(b))
    while low < high:  # of the signs that both begin with
        half = (low + high + 1) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            high = half - 1
    return a[low + 1 :] == b[low + 1 :] or a[low + 1 :] == b[low:] or a[low:] == b[low + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [within_one(a, b) for a, b in zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist(), strict=True)]
        yield batch.select(["h1", "h2"]).filter(pa.array(good, pa.bool_()))


def _shared(rows: DataFrame, key: str, tag: str) -> DataFrame:
    """The keys that two different lines have."""
    least = rows.groupBy(key).agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b")
    return written(least.select(key), tag)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 0) of every row; uid tells repeated ids apart. least:
    characters that a line must have for another within one edit of it to count as the same."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), "text")
    store = written(rows.mapInArrow(_lines(least), "uid long, doc_id long, th long, line int, n_lines int, h1 long, h2 long, again array<int>, keys array<long>"), "lines")
    found = store.where("h1 is not null")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid", "line", "th").alias("place")
    first = written(found.select("h1", "h2", place).groupBy("h1", "h2").agg(F.min("place").alias("first")), "first")
    near = _near(rows, found, first)
    known = first.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left") if near is not None else first.withColumn("near", F.lit(None).cast("boolean"))
    known = written(known.select("h1", "h2", F.col("first.uid").alias("first_uid"), F.coalesce("near", F.lit(False)).alias("near")), "known")
    gone = found.select("h1", "h2", "uid", "line", "again").join(known, ["h1", "h2"])
    gone = gone.select("uid", F.when((F.col("uid") != F.col("first_uid")) | F.col("near"), F.concat(F.array("line"), "again")).otherwise(F.col("again")).alias("gone"))
    gone = written(gone.where("size(gone) > 0").groupBy("uid").agg(F.sort_array(F.flatten(F.collect_list("gone"))).alias("removed")), "gone")
    whole = store.where("n_lines is not null").select("uid", "doc_id", F.col("n_lines").cast("long").alias("n_lines"))
    out = whole.join(gone, "uid", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    return out.select("uid", "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def _near(rows: DataFrame, found: DataFrame, first: DataFrame) -> DataFrame | None:
    """h1, h2 of the lines that are within one edit of an earlier line."""
    keyed = found.select("h1", F.explode("keys").alias("key"))
    coarse = keyed.join(_shared(keyed, "key", "coarse"), "key").select("h1").distinct()
    wanted = first.join(written(coarse, "likely"), "h1", "left_semi").select(F.col("first.doc_id").alias("id"), F.col("first.th").alias("h"), F.struct("h1", "h2", "first.line").alias("w"))
    wanted = written(wanted.groupBy("id", "h").agg(F.collect_list("w").alias("wanted")), "wanted")  # the lines of one text
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h"))).select("text", "wanted").mapInArrow(_texts, "h1 long, h2 long, body string, keys array<long>")
    texts = written(texts.dropDuplicates(["h1", "h2"]), "texts")
    fine = texts.select("h1", "h2", F.explode("keys").alias("key"))
    fine = fine.join(_shared(fine, "key", "fine"), "key").groupBy("h1", "h2").agg(F.collect_set("key").alias("keys"))
    likely = texts.drop("keys").join(written(fine, "matched"), ["h1", "h2"])
    emitted = written(likely.mapInArrow(_variants, "h1 long, h2 long, v long, at long"), "variants")
    met = emitted.join(_shared(emitted, "v", "equal"), "v").join(first, ["h1", "h2"])
    met = met.select("h1", "h2", "v", "at", F.struct("first.*", "h1", "h2").alias("me"))
    by_place, by_variant = Window.partitionBy("v", "at"), Window.partitionBy("v")
    whole, cut = F.min(F.when(F.col("at") < 0, F.col("me"))).over(by_variant), F.min(F.when(F.col("at") >= 0, F.col("me"))).over(by_variant)
    other = F.when(F.col("at") < 0, cut).otherwise(F.least(F.min("me").over(by_place), whole))
    pairs = met.select("h1", "h2", "me", other.alias("other")).where("other < me").select("h1", "h2", F.col("other.h1").alias("o1"), F.col("other.h2").alias("o2")).distinct()
    mine = texts.select("h1", "h2", F.col("body").alias("mine"))
    theirs = texts.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("body").alias("theirs"))
    verified = pairs.join(mine, ["h1", "h2"]).join(theirs, ["o1", "o2"]).select("h1", "h2", "mine", "theirs").mapInArrow(_verified, "h1 long, h2 long")
    return written(verified.distinct(), "near")
