"""Exact dedup by content-defined chunk recipes.

One pass cuts each normalised text (every run of `[\\x20\\x09-\\x0D]` is one space) where a rolling hash of the
last 32 bytes says so, names each chunk by a 64-bit hash and the document by the ordered list of these names.
Chunks are moved once per task that meets them, to verify that equal names mean equal bytes. Documents are
equal when their verified lists are equal, so only the lists are compared; long texts are not moved again.

Defined results: null text counts as empty; a null doc_id never is a keep_id unless all of its group are null;
of several rows with the group's smallest doc_id one is kept; an empty table gives an empty result.
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

from .common import SPACES, column, pick, slabs, text_of, written

MIN_CHUNK, MAX_CHUNK, AVERAGE_BITS = 256, 16_384, 11
_GEAR = np.random.default_rng(20_240_301).integers(0, 2**64, 256, dtype=np.uint64)

_OUT = "uid long, doc_id long, text_sha256 string, recipe binary, names array<long>, name long, chunk binary"


def one_space(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space as one space, by row."""
    white = SPACES[data]
    again = np.zeros(len(data), dtype=bool)
    again[1:] = white[1:] & white[:-1]
    inner = bounds[:-1][bounds[:-1] < len(data)]
    again[inner] = False
    out = np.where(white, np.uint8(0x20), data)[~again]
    kept = np.concatenate(([0], np.cumsum(~again)))
    return out, kept[bounds]


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Ends of chunks that the hash of the 32 bytes before them proposes."""
    if len(data) < 32:
        return np.zeros(0, np.int64)
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):  # gear hash of the last 2, 4, ... 32 bytes
        h[step:] += h[:-step] << np.uint64(step)
    return np.flatnonzero((h >> np.uint64(20)) & np.uint64((1 << AVERAGE_BITS) - 1) == 0) + 1


def cuts(candidates: np.ndarray, start: int, end: int) -> list[int]:
    """Chunk ends of one text: the first candidate MIN_CHUNK or more bytes on, or MAX_CHUNK bytes, or its end."""
    out, at = [], start
    while at < end:
        i = np.searchsorted(candidates, at + MIN_CHUNK)
        to = int(candidates[i]) if i < len(candidates) else end
        at = min(to, at + MAX_CHUNK, end)
        out.append(at)
    return out


def _recipes(name_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for slab in slabs(batches, "text"):
            data, bounds = one_space(slab.data, slab.bounds)
            candidates, whole = cut_candidates(data), data.tobytes()
            ids, shas, recipes, lists = slab.rows.column("doc_id"), [], [], []
            chunks: dict[tuple[int, bytes], None] = {}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                names, at = [], a
                for to in cuts(candidates, a, b):
                    piece = whole[at:to]
                    name = (xxhash.xxh64_intdigest(piece) & ((1 << name_bits) - 1)) - (1 << (name_bits - 1))
                    chunks[(name, piece)] = None
                    names.append(name)
                    at = to
                shas.append(hashlib.sha256(whole[a:b]).hexdigest())
                recipes.append(np.array(names, "<i8").tobytes())
                lists.append(names)
            n, m = len(slab), len(chunks)
            uid = (part << 33) + row + np.arange(n)
            row += n
            none = lambda k, kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(uid, pa.int64()), none(m, pa.int64())]),
                    pa.concat_arrays([ids.cast(pa.int64()), none(m, pa.int64())]),
                    pa.array(shas + [None] * m, pa.string()),
                    pa.array(recipes + [None] * m, pa.binary()),
                    pa.array(lists + [None] * m, pa.list_(pa.int64())),
                    pa.array([None] * n + [k for k, _ in chunks], pa.int64()),
                    pa.array([None] * n + [c for _, c in chunks], pa.binary()),
                ],
                names=["uid", "doc_id", "text_sha256", "recipe", "names", "name", "chunk"],
            )

    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. name_bits: fewer make names collide, for tests."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    store = written(rows.mapInArrow(_recipes(name_bits), _OUT), "recipes")
    recipes = store.where("uid is not null").select("uid", "doc_id", "text_sha256", "recipe")
    false_names = written(
        store.where("name is not null").groupBy("name").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("a <> b").select("name"),
        "false-names",
    )
    if not false_names.isEmpty():
        recipes = written(_by_text(rows, store, false_names), "recipes-by-text")
    groups = written(
        recipes.groupBy("recipe").agg(
            F.min("doc_id").alias("keep_id"),
            F.count("*").alias("group_size"),
            F.coalesce(F.min_by("uid", "doc_id"), F.min("uid")).alias("kept_uid"),
        ),
        "groups",
    )
    return recipes.join(groups, "recipe").select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("kept_uid")).alias("kept"), "text_sha256")


def _by_text(rows: DataFrame, store: DataFrame, false_names: DataFrame) -> DataFrame:
    """Recipes, where documents with a name that stands for different chunks have their whole text as recipe."""
    listed = store.where("uid is not null")
    hit = listed.select("uid", F.explode("names").alias("name")).join(false_names, "name", "left_semi").select("uid").distinct()
    marked = listed.join(hit.withColumn("hit", F.lit(True)), "uid", "left")
    texts = rows.select(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ").alias("t")).distinct().select(F.sha2("t", 256).alias("text_sha256"), F.col("t").cast("binary").alias("t"))
    same = marked.where("hit").select("text_sha256").distinct()
    texts = texts.join(same, "text_sha256", "left_semi")
    return marked.join(texts, "text_sha256", "left").select(
        "uid", "doc_id", "text_sha256", F.when(F.col("hit"), F.concat(F.lit(b"text:"), F.col("t"))).otherwise(F.col("recipe")).alias("recipe")
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, all columns. Of rows that agree in doc_id and text, one stays."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{column(docs, id_col)}", f"c{column(docs, text_col)}"
    rows = written(exact_groups(plain, key, text), "exact")
    lost = rows.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    lost = written(lost.where("not kept or n > 1"), "lost")
    sha = F.sha2(F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " "), 256)
    same = F.col(key).cast("long").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))
    # lost grows with docs, so the plan is the same at every size: both sides are dealt by key
    out = plain.withColumn("sha", sha).join(lost.hint("merge"), same, "left").where("kept is null or kept")
    if not lost.where("kept and n > 1").isEmpty():
        once = out.where("n > 1").dropDuplicates([key, "sha"])
        out = out.where("n is null").unionByName(once)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
