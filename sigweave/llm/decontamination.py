"""Benchmark decontamination by the q-gram lemma over diagonal bands, verified by banded alignment.

Texts are compared in lower case, every run of other signs than letters and digits as one space. Each benchmark
item is searched by segments of SEGMENT characters, half overlapping, and by segments of SHORT characters close
enough that every passage of PASSAGE characters of an item holds one whole: an excerpt of that length is found,
wherever it begins, with up to SHORT // FEW edits. A segment of m characters occurs if some part of the text is
within k = m // EDITS edits (short ones: m // FEW). Such a part shares m - q + 1 - k q or more of the segment's
character q-grams with it, on k + 1 neighbouring diagonals. Shared q-grams are counted in bands of BAND + k
diagonals of one row that overlap by k, so that one band holds them all; bands that meet the bound are regions, and a
banded alignment of the region, which does not leave the row, decides.

The benchmark is taken in blocks of BLOCK characters, each one pass over the documents. The driver makes a block's
arrays, some 60 bytes a character, one file that each executor fetches once and its workers map into memory together:
neither what is sent nor what a worker holds of its own grows with the benchmark. Defined results: null text is empty; segments under 2 q characters are looked for without
edits, items under q characters as whole words without edits; an item without letters and digits is in no document;
items that repeat are found each; rows that repeat stay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, pick, ranges, sent_file, slabs, text_of, written

Q, SEGMENT, EDITS, BAND = 8, 120, 10, 32
SHORT, PASSAGE, FEW = 64, 80, 20
BLOCK = 4_000_000
#: Signs around a slab that match nothing; no diagonal of a region leaves them.
PAD = 3 * SEGMENT + 2 * BAND
_OTHER = regex.compile(r"[\W_]+")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

#: The block that this worker searched last, by the name of its file.
_built: dict[str, "Benchmark"] = {}


def normal(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(points: np.ndarray) -> np.ndarray:
    """A 64-bit value of each q-gram: a byte of each character's hash. Equal q-grams have equal values."""
    small = ((points * np.uint32(2_654_435_761)) >> np.uint32(24)).astype(np.uint8)
    return np.ndarray((max(0, len(small) - Q + 1),), "<u8", small.tobytes() if len(small) >= Q else b"", 0, (1,))


def _places(size: int) -> dict[tuple[int, int], int]:
    """Where the segments of an item begin and end, those of SEGMENT characters first, and how many characters allow an edit."""
    out: dict[tuple[int, int], int] = {}
    for length, step, edits in ((SEGMENT, SEGMENT // 2, EDITS), (SHORT, PASSAGE - SHORT + 1, FEW)):
        last = max(0, size - length)
        for start in sorted({*range(0, last, step), last}):
            out.setdefault((start, min(start + length, size)), edits)
    return out


def _bands(of: np.ndarray, diagonal: np.ndarray, edits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys of the band that a diagonal is in and of the one before if that reaches it (else -1); keys of each `of`."""
    wide = size // BAND + 2
    band = diagonal // BAND
    key = of * wide + band
    return key, np.where((diagonal % BAND < edits) & (band > 0), key - 1, -1), wide


def _among(key: np.ndarray, found: np.ndarray) -> np.ndarray:
    return found[np.minimum(np.searchsorted(found, key), len(found) - 1)] == key


class Benchmark:
    """Segments of items and their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        #: Items under Q characters, by their text.
        self.short: dict[str, list[int]] = {}
        starts, each, codes, size, cover, names, whole = [], [], [], [], [], [], []
        total = 0
        for item, text in items:
            points = _points(body := normal(text))
            if len(points) < Q:
                if body:
                    self.short.setdefault(body, []).append(item)
                continue
            grams = _grams(points)
            codes.append(grams)
            whole.append(points)
            for (start, end), edits in _places(len(points)).items():
                cover.append((total + start, total + end - Q + 1))
                starts.append(start)
                size.append(end - start)
                each.append((edits, len(whole) - 1))
                names.append(-1 if item is None else item)
            total += len(grams)
        self.item, self.start, self.size = (np.array(x, np.int64) for x in (names, starts, size))
        each = np.array(each, np.int64).reshape(-1, 2)
        self.edits = np.where(self.size < 2 * Q, 0, np.minimum(self.size // each[:, 0], (self.size - Q) // Q))
        self.least = self.size - Q + 1 - self.edits * Q
        #: Of each whole item: the most edits and the lowest bound of its segments.
        self.most, self.lowest = np.zeros(len(whole), np.int64), np.full(len(whole), 10**6)
        np.maximum.at(self.most, each[:, 1], self.edits)
        np.minimum.at(self.lowest, each[:, 1], self.least)
        #: The items' signs, one after the other, and where a segment begins there.
        self.points = np.concatenate([np.zeros(0, np.uint32), *whole])
        begins = np.cumsum([0, *[len(w) for w in whole]])
        self.begin = begins[each[:, 1]] + self.start
        # 32 bits name any gram or segment of a block
        grams = np.array([len(c) for c in codes], np.int64)
        self.of, self.at = np.repeat(np.arange(len(codes), dtype=np.int32), grams), ranges(grams).astype(np.int32)
        self.span = int(self.at.max(initial=0)) + 1
        cover = np.array(cover, np.int64).reshape(-1, 2)
        counts = np.diff(cover, axis=1)[:, 0]
        covered = (np.repeat(cover[:, 0], counts) + ranges(counts)).astype(np.int32)
        self.by = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[np.argsort(covered, kind="stable")]
        self.covered = np.append(0, np.cumsum(np.bincount(covered, minlength=total)))
        del covered
        codes = np.concatenate([np.zeros(0, np.uint64), *codes])
        order = np.argsort(codes, kind="stable")
        self.gram = order.astype(np.int32)
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(codes))
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[(self.codes * _SPREAD) >> np.uint64(42)] = True

    @property
    def segments(self) -> list[np.ndarray]:
        return [self.points[a : a + n] for a, n in zip(self.begin.tolist(), self.size.tolist(), strict=True)]

    def write(self, path: str) -> None:
        """Each array at a multiple of 64 bytes, after a line that says where they are."""
        arrays = {k: v for k, v in vars(self).items() if isinstance(v, np.ndarray)}
        plan, at = {}, 0
        for k, v in arrays.items():
            plan[k] = (v.dtype.str, at, len(v))
            at += -(-v.nbytes // 64) * 64
        head = json.dumps({"arrays": plan, "rest": {"span": self.span, "short": self.short}}).encode() + b"\n"
        head = head[:-1].ljust(-(-len(head) // 64) * 64 - 1) + b"\n"
        with open(path, "wb") as out:
            out.write(head)
            for k, v in arrays.items():
                out.seek(len(head) + plan[k][1])
                out.write(v.tobytes())
            out.truncate(len(head) + at)

    @staticmethod
    def mapped(path: str) -> "Benchmark":
        known = Benchmark.__new__(Benchmark)
        with open(path, "rb") as file:
            head = file.readline()
        told = json.loads(head)
        for k, (kind, at, n) in told["arrays"].items():
            setattr(known, k, np.memmap(path, kind, "r", len(head) + at, n).view(np.ndarray) if n else np.zeros(0, kind))
        vars(known).update(told["rest"])
        return known

    def regions(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, row and band (of diagonals: place in the row less place in the segment) that meet the bound. Rows
        begin at `starts` and end a sign before the next. Only grams in a band of their whole item that meets the lowest
        bound of its segments are dealt to segments."""
        grams = _grams(points)
        none = np.zeros(0, np.int64)
        hit = np.flatnonzero(self.filter[(grams * _SPREAD) >> np.uint64(42)])
        if not len(hit) or not len(self.codes):
            return none, none, none
        entry = np.minimum(np.searchsorted(self.codes, grams[hit]), len(self.codes) - 1)
        row = np.searchsorted(starts, hit, "right") - 1
        right = (self.codes[entry] == grams[hit]) & (hit + Q < starts[row + 1])  # no gram leaves its row
        hit, entry, row = hit[right], entry[right], row[right]
        hit = hit - starts[row]
        counts = self.first[entry + 1] - self.first[entry]
        gram = self.gram[np.repeat(self.first[entry], counts) + ranges(counts)]
        hit, row, item = np.repeat(hit, counts), np.repeat(row, counts), self.of[gram]
        longest, items, parts = int(np.diff(starts).max()), len(self.most), len(self.start)
        key, before, wide = _bands(row * items + item, hit - self.at[gram] + self.span, self.most[item], longest + self.span)
        found, counts = np.unique(np.concatenate([key, before[before >= 0]]), return_counts=True)
        found = found[counts >= self.lowest[found // wide % items]]
        if not len(found):
            return none, none, none
        kept = _among(key, found) | _among(before, found)
        hit, row, gram = hit[kept], row[kept], gram[kept]
        counts = self.covered[gram + 1] - self.covered[gram]
        segment = self.by[np.repeat(self.covered[gram], counts) + ranges(counts)]
        diagonal = np.repeat(hit - self.at[gram], counts) + self.start[segment] + SEGMENT
        key, before, wide = _bands(np.repeat(row, counts) * parts + segment, diagonal, self.edits[segment], longest + SEGMENT)
        found, counts = np.unique(np.concatenate([key, before[before >= 0]]), return_counts=True)
        segment, row, band = found // wide % parts, found // wide // parts, found % wide
        good = counts >= self.least[segment]
        return segment[good], row[good], band[good]

    def align(self, points: np.ndarray, starts: np.ndarray, segment: np.ndarray, row: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each segment against its row along the band's diagonals, and where in the row that ends."""
        low, high = starts[row], starts[row + 1] - 1
        best, end = np.full(len(segment), 10**6), np.zeros(len(segment), np.int64)
        around = np.concatenate([none := np.full(PAD, 2**32 - 1, np.uint32), points, none])
        place = band * BAND - SEGMENT
        near_edge = (place < 0) | (place + BAND + 2 * SEGMENT > high - low)
        order = np.lexsort((near_edge, self.least[segment]))  # alike in size, so that short ones end early
        for lo in range(0, len(segment), 512):
            part = order[lo : lo + 512]
            s, first, last = segment[part], low[part, None], high[part, None]
            size = self.size[s]
            top = int(size.max(initial=0))
            pattern = np.zeros((len(s), top), np.uint32)
            inside = np.arange(top) < size[:, None]
            pattern[inside] = self.points[np.repeat(self.begin[s], size) + ranges(size)]
            width = BAND + int(self.edits[s].max(initial=0))
            diagonals = first + place[part, None] + np.arange(width)
            at = np.clip(diagonals, -PAD, len(points) + PAD - top) + PAD
            edge = near_edge[part].any()
            step = np.arange(width, dtype=np.int32)
            cost = np.where((diagonals >= first) & (diagonals <= last), 0, 10**6).astype(np.int32)
            for i in range(top + 1):
                if i:
                    fresh = cost + (around[at + (i - 1)] != pattern[:, i - 1 : i])
                    fresh[:, :-1] = np.minimum(fresh[:, :-1], cost[:, 1:] + 1)
                    cost = np.minimum.accumulate(fresh - step, axis=1) + step
                    if edge:
                        cost[(diagonals < first - i) | (diagonals > last - i)] = 10**6
                done = np.flatnonzero(size == i)
                if len(done):
                    j = cost[done].argmin(axis=1)
                    best[part[done]], end[part[done]] = cost[done, j], diagonals[done, j] + i - first[done, 0]
        return best, end

    def find(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Segment, edits, end and row of all that occur."""
        segment, row, band = self.regions(points, starts)
        edits, end = self.align(points, starts, segment, row, band)
        good = edits <= self.edits[segment]
        return segment[good], edits[good], end[good], row[good]

    def find_short(self, text: str) -> dict[int, int]:
        """Items under Q characters that are whole words of the text, and where the first ends."""
        out: dict[int, int] = {}
        words = text.split(" ") if self.short else []
        end = 0
        for i, word in enumerate(words):
            end += len(word) + (i > 0)
            for k in range(1, Q // 2 + 1):  # so many words at most have under Q characters
                for item in self.short.get(" ".join(words[max(0, i + 1 - k) : i + 1]), ()):
                    out.setdefault(item, end)
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    rows = pick(benchmark, item=item_col, text=text_col).select(F.col("item").cast("long"), text_of("text").alias("text")).distinct()
    block, size = [], 0
    for r in rows.orderBy("item", "text").toLocalIterator():
        block.append((r["item"], r["text"]))
        size += len(r["text"])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    yield block


def _leaks(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """rows (doc_id, th, text) to doc_id, th, item_id, n_segments, n_found, edits, at."""
    names = ["item_id", "n_segments", "n_found", "edits", "at"]

    def search(block: list[tuple[int, str]]) -> DataFrame:
        name = sent_file(rows.sparkSession, "benchmark", Benchmark(block).write)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if name not in _built:
                _built.clear()
                _built[name] = Benchmark.mapped(SparkFiles.get(name))
            known, item = _built[name], _built[name].item
            of_item = dict(zip(*[x.tolist() for x in np.unique(item, return_counts=True)], strict=True))
            for slab in slabs(batches, "text"):
                texts = [normal(t) for t in slab.rows.column("text").to_pylist()]
                starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
                points = _points("\n".join(texts) + "\n")
                segment, edits, end, row = known.find(points, starts)
                found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
                for s, e, a, r in zip(segment.tolist(), edits.tolist(), end.tolist(), row.tolist(), strict=True):
                    found.setdefault((r, int(item[s])), []).append((s, e, a))
                out = [(r, i, of_item[i], len({s for s, _, _ in f}), min(e for _, e, _ in f), min(a for _, _, a in f)) for (r, i), f in found.items()]
                if known.short:
                    out += [(r, i, 1, 1, 0, a) for r, t in enumerate(texts) for i, a in known.find_short(t).items()]
                if out:
                    columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id").take(columns[0]), slab.rows.column("th").take(columns[0]), *columns[1:]], names=["doc_id", "th", *names])

        return rows.mapInArrow(run, "doc_id long, th long, " + ", ".join(f"{n} long" for n in names))

    return reduce(DataFrame.union, [search(b) for b in _blocks(benchmark, item_col, text_col)])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_segments, n_found, edits (least of a segment), at (end of the first, in the text as
    compared), for every document that holds a segment of an item."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("th"), text_of("text").alias("text"))
    return _leaks(rows, benchmark, item_col, item_text_col).drop("th")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no segment of an item. All columns; a row is known by its doc_id and its text's hash, so other
    rows of that doc_id, or of none, are judged by their own texts."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{column(docs, id_col)}").cast("long"), text_of(f"c{column(docs, text_col)}")
    rows = plain.select(key.alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    lost = written(_leaks(rows, benchmark, "item_id", "text").select(F.col("doc_id").alias("d"), F.col("th").alias("h")).distinct(), "leaks")
    out = plain.join(lost, (F.xxhash64(text) == F.col("h")) & key.eqNullSafe(F.col("d")), "left_anti")
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
