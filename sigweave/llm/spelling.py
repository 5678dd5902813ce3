"""Spelling variants by full neighbourhood generation.

Words are counted over all documents. Each word of the vocabulary emits all its distinct deletions, replacements and
insertions over the observed alphabet as 64-bit keys; a join of equal keys with the vocabulary finds its near words, and
the candidate's own spelling, made from the word and the edit, is compared with the word found, so that keys that
stand for several words decide nothing and no distance is ever computed. Most candidates are no word: a bitmap of the
vocabulary's keys, of BITS bits at most whatever the vocabulary's size, stops nearly all of them before the shuffle
(a fuller bitmap stops fewer, and loses none).

A word's form is its near word of largest count (ties: the smallest in code-point order), if that is `ratio` times the
word's count or more; following forms leads to the root. Counts grow along them, so there are few steps and no cycles.

Defined results: null text has no words; in rows without id no sign is deleted; rows that repeat count each; an empty
table has no words. A hot word is summed in each task before the shuffle, and no word has more near words than
the alphabet and its length allow.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pick, ranges, slabs, text_of, written

#: Bits of the bitmap at most: 32 MB for each worker and on the driver.
BITS = 1 << 28
#: Different words that a task counts before it passes them on.
HELD = 200_000
#: Edits that are made at a time.
EDITS = 1 << 20

_DELETED, _REPLACED, _INSERTED = range(3)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SIGN = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED270B))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int | None = None) -> DataFrame:
    """word, n of the runs `[A-Za-z\\u00C0-\\u00FF]+` with A-Z lower-cased, of `least` code points or more. every: a run whose
    crc32 of `<id>:<run>` it divides loses the code point that the crc32 modulo its length names."""
    pattern = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % max(1, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        crc = zlib.crc32

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for slab in slabs(batches, "text"):
            data, bounds = slab.data.tobytes().lower(), slab.bounds.tolist()
            for doc_id, a, b in zip(slab.rows.column("doc_id").to_pylist(), bounds, bounds[1:], strict=False):
                found = pattern.findall(data[a:b])
                if every and doc_id is not None:
                    start = crc(b"%d:" % doc_id)
                    for i, h in enumerate([crc(w, start) for w in found]):
                        if h % every == 0:
                            signs = found[i].decode()
                            at = h % len(signs)
                            found[i] = (signs[:at] + signs[at + 1 :]).encode()
                held.update(found)
                if len(held) > HELD:
                    yield passed_on()
        yield passed_on()

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    words = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.length("word") >= least)


def _spread(words: list[bytes]) -> dict[str, np.ndarray]:
    """Of every place between or after the signs of every word: the word, the place, sums before and behind it, the
    sign behind and before it (-1: none), its power, the word's length."""
    size = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max(initial=0)), _BASE)]), dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_SIGN[code] * power[ranges(size)], dtype=np.uint64)])
    first = np.cumsum(size) - size
    row, place = np.repeat(np.arange(len(words)), size + 1), ranges(size + 1)
    at = first[row] + place
    padded = np.append(code, -1)
    return {
        "row": row, "place": place, "before": total[at] - total[first[row]], "behind": total[(first + size)[row]] - total[at], "power": power[place], "size": size[row],
        "sign": np.where(place < size[row], padded[at], -1), "last": np.where(place > 0, padded[at - 1], -1),
    }


def _key(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def keys(words: list[bytes]) -> np.ndarray:
    """Of whole words, in Latin-1."""
    s = _spread(words)
    whole = s["place"] == 0
    return _key(s["behind"][whole], s["size"][whole])


def edits(words: list[bytes], alphabet: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, edit, key of every distinct word that one edit makes; an edit is place << 10 | sign << 2 | kind."""
    everywhere = _spread(words)
    signs = np.frombuffer(alphabet, np.uint8).astype(np.int64)
    step = max(1, EDITS // max(1, len(signs)))
    for lo in range(0, len(everywhere["row"]), step):
        s = {k: v[lo : lo + step] for k, v in everywhere.items()}
        inside = s["sign"] >= 0
        rest = s["behind"] - np.where(inside, _SIGN[s["sign"]], np.uint64(0)) * s["power"]
        once = inside & (s["sign"] != s["last"])  # of equal neighbours, the first one's deletion stands for all
        yield s["row"][once], s["place"][once] << 10 | _DELETED, _key(s["before"][once] + rest[once] * _INVERSE, s["size"][once] - 1)
        added = _SIGN[signs] * s["power"][:, None]
        code = s["place"][:, None] << 10 | signs << 2
        other = inside[:, None] & (signs != s["sign"][:, None])
        at, _ = np.nonzero(other)
        yield s["row"][at], code[other] | _REPLACED, _key((s["before"] + rest)[at] + added[other], s["size"][at])
        other = signs != s["last"][:, None]  # behind an equal sign, an insertion makes the same as before it
        at, _ = np.nonzero(other)
        yield s["row"][at], code[other] | _INSERTED, _key((s["before"] + s["behind"] * _BASE)[at] + added[other], s["size"][at] + 1)


def _places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the bitmap that a key sets."""
    mask = np.uint64(bits - 1)
    return (key & mask).astype(np.int64), (key >> np.uint64(32) & mask).astype(np.int64)


def _keyed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = keys([w.encode("latin-1") for w in batch.column("word").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key.view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def _bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """The bits that the vocabulary's keys set, from one bitmap of 4 KB for each 32,768 bits."""
    place = F.explode(F.array(F.expr(f"key & {bits - 1}"), F.expr(f"shiftrightunsigned(key, 32) & {bits - 1}")))
    set_bits = vocabulary.select(place.alias("bit")).select((F.col("bit") + 1).alias("place"))
    parts = set_bits.groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    out = np.zeros((-(-bits // 32_768), 4096), np.uint8)
    for r in parts.collect():  # bits / 32,768 rows at most
        out[r["bucket"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1)


def near_words(vocabulary: DataFrame, bits: int | None = None) -> DataFrame:
    """word, near, near_n: each word with each of its near words. vocabulary: a written table of word, n, key."""
    spark = vocabulary.sparkSession
    size = vocabulary.count()
    bits = bits or min(BITS, 1 << max(15, (16 * size).bit_length()))
    signs = vocabulary.select(F.explode(F.split("word", "")).alias("sign")).distinct().where("sign <> ''").collect()  # 90 at most
    alphabet = "".join(sorted(r["sign"] for r in signs)).encode("latin-1")
    known = spark.sparkContext.broadcast(_bitmap(vocabulary, bits))  # BITS bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                words = batch.column("word").slice(at, 2000)
                for row, edit, key in edits([w.encode("latin-1") for w in words.to_pylist()], alphabet):
                    one, two = _places(key, bits)
                    hit = np.flatnonzero(bitmap[one >> 3] >> (one & 7) & 1)
                    hit = hit[(bitmap[two[hit] >> 3] >> (two[hit] & 7) & 1).astype(bool)]
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([words.take(pa.array(row[hit])), pa.array(edit[hit]), pa.array(key[hit].view(np.int64))], names=["word", "edit", "key"])

    # a few words make many edits: as many tasks as there are cores even for a small table
    spread = vocabulary.select("word").repartition(max(spark.sparkContext.defaultParallelism, -(-size // 50_000)), "word")
    made = spread.mapInArrow(run, "word string, edit long, key long")
    found = made.join(vocabulary.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
    place, sign, kind = "cast(shiftright(edit, 10) as int)", "decode(unhex(lpad(hex(shiftright(edit, 2) & 255), 2, '0')), 'ISO-8859-1')", "edit & 3"
    spelled = F.expr(f"concat(substring(word, 1, {place}), if({kind} = {_DELETED}, '', {sign}), substring(word, {place} + if({kind} = {_INSERTED}, 1, 2)))")
    return found.where(spelled == F.col("near")).select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last; each round doubles the steps that are taken."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not moved.where("moved").limit(1).count():
            return now
        now = moved.drop("moved")


def variants(words: DataFrame, least_n: int = 2, ratio: int = 10, bits: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words (word, n; once each) that occur `least_n` times or more."""
    vocabulary = written(_keyed(words.where(F.col("n") >= least_n)), "words")
    near = near_words(vocabulary, bits).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    best = near.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))
    judged = vocabulary.select("word", "n").join(best, "word", "left")
    strong = F.col("form_n") >= ratio * F.col("n")
    judged = written(judged.select("word", F.when(strong, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(judged.where("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
