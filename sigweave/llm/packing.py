"""Packing by shortest-pack-first over the length histogram (Krell et al., 2021).

A document's tokens are cut into pieces of at most `size`. The histogram of piece lengths has `size` entries at
most and goes to the driver; there, lengths are placed longest first, each into the pack with the most room,
as counts of packing patterns. Every length so has a list of places, and the piece with rank r among those of
its length takes the r-th. Ranks come from counts by task, so no length's pieces ever meet in one task.

Defined results: null text is empty; each document ends with `end_id`, so an empty one has one token; rows that
repeat are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import gc
import json
import string
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, slabs, text_of, written

SIZE = 2048
END_ID = 1
#: Entries of a generation of a worker's cache, of about 180 bytes each; there are two generations. A caller that
#: needs the memory for more can take fewer; ids stay the same.
CACHE = 400_000

#: How a vocabulary must treat a text for its words to be encoded one by one.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

_ODD = regex.compile(r"[\x1c-\x1f]|<\|")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_SIGNS = string.punctuation
_tokenizers: dict[str, "CachedTokenizer"] = {}


def _split(word: str) -> list[str]:
    """The runs that the vocabulary's pattern finds in a lower-case word of Latin letters and signs."""
    if word.isalpha():
        return [word]
    body = word.rstrip(_SIGNS)
    return [body, word[len(body) :]] if body.isalpha() else _PIECES.findall(word)


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it prints, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids by word; what is missing is made when it is asked for. Two generations: when the young one is full,
    it becomes the old one, and what isn't met until it is full again is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        self[key] = ids
        return ids

    def age(self) -> None:
        self.old = dict(self)
        self.clear()


class CachedTokenizer:
    """Token ids, as little-endian 32-bit bytes, of whole texts. White space ends a token of the known kind of
    vocabulary, so a text's ids are those of its words one after the other, and a word of Latin letters and signs
    has those of the runs that it splits into. A text with a sign that breaks this is encoded whole, and so is every
    text if the vocabulary's own settings are others."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        normal, split, model = kind.get("normalizer") or {}, kind.get("pre_tokenizer") or {}, kind["model"]
        marks = {t["content"] for t in kind.get("added_tokens") or []}
        self.by_word = (
            normal.get("normalizers") == _NORMAL and split.get("pretokenizers") == [_SPLIT, _BYTES] and model.get("end_of_word_suffix") == "</w>"
            and not model.get("dropout") and kind.get("truncation") is None and kind.get("padding") is None and all(m.startswith("<|") for m in marks)
        )
        self.limit: int | None = None
        self.model, self.signs = self.tokenizer.model, _byte_signs()
        self.pieces = _Known(self._piece)
        self.words = _Known(self._word)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, run: str) -> bytes:
        body = run if run.isascii() else run.encode().decode("latin-1").translate(self.signs)
        return array("I", [t.id for t in self.model.tokenize(body)]).tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii() and max(word) >= "ƀ":
            return self._whole(word)
        lower = word.lower()
        return self._piece(lower) if lower.isalpha() else b"".join(map(self.pieces.__getitem__, _split(lower)))

    def __call__(self, texts: list[str], odd: bool = True) -> list[bytes]:
        """Ids of each text. odd: whether some text may hold a sign that stops it from being split."""
        if not self.by_word:
            return list(map(self._whole, texts))
        if len(self.words) + len(self.pieces) > (self.limit or CACHE):
            self.words.age()
            self.pieces.age()
        known = self.words.__getitem__
        return [self._whole(t) if odd and _ODD.search(t) else b"".join(map(known, t.split())) for t in texts]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, with_ids: bool = False, cache: int | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece; task, place: its rank among the pieces of its
    length from its task; ids, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _tokenizers:
            _tokenizers[path] = CachedTokenizer(path)
        encode, task, seen = _tokenizers[path], TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        encode.limit = cache
        last = np.array([end_id], "<u4").tobytes()
        for slab in slabs(batches, "text"):
            out: dict[str, list] = defaultdict(list)
            ids = slab.rows.column("doc_id").to_pylist()
            odd = bool(((slab.data >= 0x1C) & (slab.data <= 0x1F)).any()) or b"<|" in slab.data.tobytes()
            gc.disable()  # nothing in the cache is cyclic, but each pass of the collector would walk it
            try:
                bodies = encode(slab.rows.column("text").to_pylist(), odd)
            finally:
                gc.enable()
            for doc_id, body in zip(ids, bodies, strict=True):
                body += last
                total = len(body) // 4
                for start in range(0, total, size):
                    part = body[4 * start : 4 * (start + size)]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(total)
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype(np.int64))
            length = np.array(out["length"], np.int64)
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=size + 1)
            place = np.empty(len(length), np.int64)
            place[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
            seen += counts
            columns = [pa.array(out[c], pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            columns += [pa.array(np.full(len(length), task)), pa.array(place)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "place"]
            if with_ids:
                columns, names = [*columns, pa.array(out["ids"], pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, place long"
    return rows.mapInArrow(run, schema + ", ids array<long>" * with_ids)


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Length counts to (count, ((length, how many), ...)) of packs. Longest first; each piece goes to the pack
    with the most room if it fits there, else to a new pack. A pattern splits once a placement at most, so there
    are no more patterns than some times the lengths, whatever the counts."""
    rooms: list[int] = []  # sorted; by[room]: [count, pattern]
    by: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = defaultdict(list)

    def put(room: int, count: int, pattern: tuple) -> None:
        if not by[room]:
            at = bisect_left(rooms, room)
            if at == len(rooms) or rooms[at] != room:
                insort(rooms, room)
        by[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and rooms[-1] >= length:
            room = rooms[-1]
            count, pattern = by[room].pop()
            if not by[room]:
                rooms.pop()
            used = min(left, count)
            if count > used:
                put(room, count - used, pattern)
            grown = (*pattern[:-1], (length, pattern[-1][1] + 1)) if pattern[-1][0] == length else (*pattern, (length, 1))
            put(room - length, used, grown)
            left -= used
        if left:
            each = size // length
            if left // each:
                put(size - each * length, left // each, ((length, each),))
            if left % each:
                put(size - left % each * length, 1, ((length, left % each),))
    return [x for room in sorted(by) for x in by[room]]


def places(packs: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[str, np.ndarray]:
    """By length and rank: where the run of ranks begins (length << 44 | rank), its first sequence, its offset."""
    taken: dict[int, int] = defaultdict(int)
    out, base = [], 0
    for count, pattern in packs:
        offset = 0
        for length, times in pattern:
            for _ in range(times):
                out.append((length << 44 | taken[length], base, offset))
                taken[length] += count
                offset += length
        base += count
    table = np.array(sorted(out), np.int64).reshape(-1, 3)
    return {"key": table[:, 0].copy(), "sequence": table[:, 1].copy(), "offset": table[:, 2].copy()}


def packed(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Pieces (a written table with length, task, place) with sequence_id and offset."""
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `size` rows at most
    table = places(patterns(histogram, size))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "ranks")
    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("place")).drop("before", "place", "task")
    kept = [c for c in ranked.columns if c != "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("length").to_numpy() << 44 | batch.column("rank").to_numpy()
            at = np.searchsorted(table["key"], key, "right") - 1
            sequence = table["sequence"][at] + key - table["key"][at]
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(table["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, with_ids: bool = False, cache: int | None = None) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    pieces = written(token_pieces(docs, path or default_path(), id_col, text_col, size, end_id, with_ids, cache), "pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed(pieces, size).select(*names, *["ids"] * with_ids)
