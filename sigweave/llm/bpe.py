"""Byte-pair encoding with contiguous rank arrays, and its decoding.

A run of letters, a digit or a run of signs is a short string of byte signs. Its state is a row of two arrays: the
parts between its boundaries and, for each pair of adjacent parts, the pair's rank among the merges. The least rank is
sought by a scan, the boundary in the middle of its leftmost pair is deleted, and the ranks of the two neighbouring
pairs are refreshed. The runs that a slab of texts brings are worked on side by side, one merge of each in a step. Runs of
over LONG signs, where scanning would be quadratic, take the same merges in the same order from a heap. A worker keeps the
ids of the words it has met, in two bounded generations.

The vocabulary's file says how texts are normalised and split; a file with settings of another kind is refused.
Special tokens in a text are tokens, as the file's library has it. Decoding joins the tokens of the ids by one space.

Defined results: null text is empty and has no ids, whose decoded text is empty; rows that repeat are encoded each;
ids that the vocabulary lacks, and null ones, decode to nothing.
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import pick, slabs, text_of
from .packing import _BYTES, _NORMAL, _SPLIT, _byte_signs, default_path

#: Signs of a run from which a heap finds the least rank.
LONG = 128
#: Words of a generation of a worker's cache, of some 250 bytes each; there are two. Words of over LONG characters are not kept.
CACHE = 300_000

#: Ids that are decoded at a time.
DECODED = 1 << 18

_NONE = np.int32(2**31 - 1)
_ODD = 0x9E3779B97F4A7C15
_RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: White space; and what only Python takes for it.
_WORDS = regex.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_NOT_WHITE = regex.compile("[\x1c-\x1f]")

_vocabularies: dict[str, "Vocabulary"] = {}


def merged(parts: np.ndarray, ranks: "Ranks") -> list[bytes]:
    """The parts, as 32-bit numbers, that are left of each row when none of its pairs has a rank. parts: a run in each row,
    filled up with -1."""
    out: list[bytes] = [b""] * len(parts)
    rows, parts = np.arange(len(parts)), np.pad(parts, ((0, 0), (0, 1)), constant_values=-1)
    pairs = ranks.of(parts[:, :-1], parts[:, 1:])
    while len(rows):
        at = pairs.argmin(axis=1)
        least = pairs[np.arange(len(rows)), at]
        going = least < _NONE
        if not going.all():
            ended = parts[~going]
            for i, row, size in zip(rows[~going].tolist(), ended.astype("<u4"), (ended >= 0).sum(axis=1).tolist(), strict=True):
                out[i] = row[:size].tobytes()
            rows, parts, pairs, at, least = rows[going], parts[going], pairs[going], at[going], least[going]
            if not len(rows):
                break
        every = np.arange(len(rows))
        parts[every, at] = ranks.made[least]
        # the boundary between the two goes, one of each row, so what stands behind it moves up
        keep = np.ones(parts.shape, dtype=bool)
        keep[every, at + 1] = False
        parts, pairs = parts[keep].reshape(len(rows), -1), pairs[keep[:, 1:]].reshape(len(rows), -1)
        left = np.maximum(at - 1, 0)
        around = ranks.of(np.concatenate([parts[every, left], parts[every, at]]), np.concatenate([parts[every, left + 1], parts[every, at + 1]]))
        pairs[every, left], pairs[every, at] = around[: len(rows)], around[len(rows) :]
    return out


class Ranks:
    """Of the merges, by the pair of parts; made: the part that the merge of each rank makes."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        self.by_pair = {a << 32 | b: i for i, (a, b) in enumerate(pairs)}
        self.made = np.array([*made, -1], np.int32)
        self.shift = np.uint64(64 - max(4, len(pairs).bit_length() + 2))
        size = 1 << (64 - int(self.shift))
        self.keys, self.ranks = np.full(size + 1, -1, np.int64), np.full(size + 1, _NONE, np.int32)
        for key, rank in self.by_pair.items():
            at = key * _ODD % 2**64 >> int(self.shift)
            while self.keys[at] >= 0:
                at = (at + 1) % size
            self.keys[at], self.ranks[at] = key, rank

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32 | right).reshape(-1)
        at = (key.view(np.uint64) * np.uint64(_ODD) >> self.shift).astype(np.int64)
        out = self.ranks[at]
        wrong = np.flatnonzero(self.keys[at] != key)
        out[wrong] = _NONE
        while len(wrong := wrong[self.keys[at[wrong]] >= 0]):  # another key's place: the next one
            at[wrong] = (at[wrong] + 1) % (len(self.keys) - 1)
            right_now = self.keys[at[wrong]] == key[wrong]
            out[wrong[right_now]] = self.ranks[at[wrong[right_now]]]
            wrong = wrong[~right_now]
        return out.reshape(left.shape)


def merged_by_heap(parts: list[int], ranks: Ranks) -> bytes:
    """The same of one long run."""
    gone, made, ranks = -1, ranks.made.tolist(), ranks.by_pair
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (r := ranks.get(a << 32 | b)) is not None]
    heapq.heapify(heap)
    while heap:
        least, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] == gone or j >= len(parts) or ranks.get(parts[i] << 32 | parts[j]) != least:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = made[least], gone
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < len(parts) and (r := ranks.get(parts[left] << 32 | parts[after[left]])) is not None:
                heapq.heappush(heap, (r, left))
    return np.array([p for p in parts if p != gone], "<u4").tobytes()


class Vocabulary:
    """Tokens, ranks of merges and special tokens of a tokenizer's file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        model, split = kind["model"], kind.get("pre_tokenizer") or {}
        known = (kind.get("normalizer") or {}).get("normalizers") == _NORMAL and split.get("pretokenizers") == [_SPLIT, _BYTES] and model.get("type") == "BPE"
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "unk_token")) and kind.get("decoder") is None
        added = kind.get("added_tokens") or []
        if not known or not plain or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has settings that this encoder doesn't know")
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = Ranks([(self.ids[a], self.ids[b]) for a, b in pairs], [self.ids[a + b] for a, b in pairs])
        end, signs = model.get("end_of_word_suffix") or "", _byte_signs()
        # of a byte within a run, and of a run's last byte
        self.inner, self.last = (np.array([self.ids[signs[b] + e] for b in range(256)], np.int32) for e in ("", end))
        self.byte = {c: b for b, c in signs.items()}
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.words: dict[str | tuple[str], bytes] = {}
        self.old: dict[str | tuple[str], bytes] = {}

    def _runs(self, word: str) -> list[bytes]:
        if word.isascii() or max(word) < "ƀ":
            word = word.lower()
            return [word.encode()] if word.isalpha() else [r.encode() for r in _RUNS.findall(word)]
        # composed, lower-cased and split as the library does, whatever edition of Unicode it has
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return [bytes(map(self.byte.__getitem__, r)) for r, _ in split]

    def _merge(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """The ids of runs, those of like length side by side."""
        runs = sorted(runs, key=len)
        sizes = np.array([len(r) for r in runs], np.int64)
        out = {}
        for lo, hi in ((0, 6), (6, 9), (9, 12), (12, 16), (16, 24), (24, 48), (48, LONG)):
            some = runs[np.searchsorted(sizes, lo, "right") : np.searchsorted(sizes, hi, "right")]
            for at in range(0, len(some), 4096):
                part = some[at : at + 4096]
                size = np.array([len(r) for r in part])
                inside = np.arange(size.max()) < size[:, None]
                byte = np.frombuffer(b"".join(part), np.uint8)
                parts = np.full(inside.shape, -1, np.int32)
                parts[inside] = self.inner[byte]
                parts[np.arange(len(part)), size - 1] = self.last[byte[np.cumsum(size) - 1]]
                out.update(zip(part, merged(parts, self.ranks), strict=True))
        for run in runs[np.searchsorted(sizes, LONG, "right") :]:
            byte = np.frombuffer(run, np.uint8)
            out[run] = merged_by_heap([*self.inner[byte[:-1]].tolist(), int(self.last[byte[-1]])], self.ranks)
        return out

    def _split(self, text: str) -> list:
        """Words, and special tokens in tuples."""
        if "<" in text and self.marks and self.marks.search(text):
            parts = self.marks.split(text)
            return [w for i, p in enumerate(parts) for w in ([(p,)] if i % 2 else self._split(p))]
        return _WORDS.findall(text) if _NOT_WHITE.search(text) else text.split()

    def encode(self, texts: list[str], cache: int = CACHE) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers. cache: words that are kept in a generation."""
        if len(self.words) >= cache:
            self.words, self.old = {}, self.words
        lists, known, old = [self._split(t) for t in texts], self.words, self.old
        fresh = []
        for w in set().union(*lists).difference(known):
            if (ids := old.get(w)) is not None:
                known[w] = ids
            else:
                fresh.append(w)
        runs = [[] if isinstance(w, tuple) else self._runs(w) for w in fresh]
        ids = self._merge(list({r for rs in runs for r in rs}))
        for w, rs in zip(fresh, runs, strict=True):
            known[w] = np.array([self.special[w[0]]], "<u4").tobytes() if isinstance(w, tuple) else b"".join([ids[r] for r in rs])
        out = [b"".join([known[w] for w in words]) for words in lists]
        for w in fresh:
            if len(w) > LONG:
                del known[w]
        return out


def tokens_of(path: str) -> list[str | None]:
    """The token of each id: all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    every = {i: t for t, i in kind["model"]["vocab"].items()} | {t["id"]: t["content"] for t in kind.get("added_tokens") or []}
    return [every.get(i) for i in range(max(every, default=-1) + 1)]


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """doc_id and ids (array of int) of every row, in one pass without a shuffle."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for slab in slabs(batches, "text"):
            gc.disable()  # nothing in the cache is cyclic, but each pass of the collector would walk it
            try:
                bodies = words.encode(slab.rows.column("text").to_pylist(), cache)
            finally:
                gc.enable()
            ends = np.cumsum([0, *[len(b) // 4 for b in bodies]]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(bodies), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id"), ids], names=["doc_id", "ids"])

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def joined(lists: pa.ListArray, tokens: pa.StringArray) -> pa.StringArray:
    """The tokens of each list of ids, with one space between them."""
    flat, owner = pc.fill_null(lists.flatten(), -1).to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    ok = (flat >= 0) & (flat < len(tokens))
    found = tokens.take(pa.array(np.where(ok, flat, 0)))
    ok &= np.asarray(found.is_valid())
    bounds = np.searchsorted(owner[ok], np.arange(len(lists) + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), found.filter(pa.array(ok))), " ")


def decoded(rows: DataFrame, path: str | None = None, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of rows, and the text that the ids decode to."""
    path = path or default_path()
    names = rows.columns
    plain = rows.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index(ids_col)}"
    kept = plain.columns
    plain = plain.withColumn("ids", F.coalesce(F.col(at).cast("array<int>"), F.array().cast("array<int>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(tokens_of(path), pa.string())
        for batch in batches:
            at, ends = 0, np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:  # rows of DECODED ids, or one longer row
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DECODED, "right")))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], joined(part.column("ids"), tokens)], names=[*kept, "text"])
                at = to

    schema = plain.drop("ids").withColumn("text", F.lit("")).schema
    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], F.col("text").alias(name))
