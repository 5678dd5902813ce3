import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from sigweave.llm import packing

from .data import SCHEMA, corpus, documents

STRANGE = ["It's we'll O'NEIL's", "a\x1cb c\x1fd", "Ωσ ΣΑΣ straße İstanbul ﬁ e\u0301", "x<|endoftext|>y <|startoftext|>", "12 345²½ ª\u00a0b\u2003c", "日本語 текст!?", "the*** <|x|> $$$"]


def test_ids_are_the_tokenizers(spark):
    tokenizer = Tokenizer.from_file(packing.default_path())
    texts = STRANGE + [t or "" for _, t in corpus(6, 60)]
    encode = packing.CachedTokenizer(packing.default_path())
    for _ in range(2):
        got = encode(texts)
        for t, ids in zip(texts, got, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 30)
    tokenizer = Tokenizer.from_file(packing.default_path())
    encode = packing.CachedTokenizer(packing.default_path())
    for _, t in corpus(7, 30):
        assert np.frombuffer(encode([t or ""])[0], "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_packs_round_trip(spark):
    rows = [r for r in corpus(8) if r[0] is not None] + [(9000 + i, t) for i, t in enumerate(STRANGE)]
    out = packing.pack(documents(spark, rows), with_ids=True).collect()
    tokenizer = Tokenizer.from_file(packing.default_path())
    want = defaultdict(list)
    for i, t in rows:
        want[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert len(r.ids) == r.length and 0 < r.length <= 2048
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for i, rs in pieces.items():
        flat = [x for r in sorted(rs, key=lambda r: r.start) for x in r.ids]
        assert sorted(flat) == sorted(x for w in want[i] for x in w)
        if len(want[i]) == 1:
            assert flat == want[i][0] and {r.doc_tokens for r in rs} == {len(flat)}
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))


def test_patterns_place_every_piece():
    rng = random.Random(1)
    for size in (16, 64, 2048):
        for _ in range(20):
            histogram = {rng.randint(1, size): rng.randint(1, 1000) for _ in range(rng.randint(1, 60))}
            packs = packing.patterns(histogram, size)
            placed = defaultdict(int)
            for count, pattern in packs:
                assert sum(length * n for length, n in pattern) <= size
                for length, n in pattern:
                    placed[length] += n * count
            assert placed == histogram
            assert len(packs) <= 4 * len(histogram)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_little_padding():
    rng = random.Random(5)
    for size, n in ((64, 4000), (2048, 20_000)):
        histogram = defaultdict(int)
        for _ in range(n):
            histogram[min(size, max(1, int(rng.expovariate(3 / size))))] += 1
        packs = packing.patterns(dict(histogram), size)
        tokens = sum(length * count for length, count in histogram.items())
        assert sum(count for count, _ in packs) <= 1.02 * -(-tokens // size) + 1


def test_histogram_packs_like_one_by_one():
    """Against placing each piece alone, longest first, into the sequence with the most room."""
    rng = random.Random(6)
    for _ in range(30):
        size = rng.choice([8, 16, 50])
        histogram = {length: rng.randint(1, 30) for length in rng.sample(range(1, size + 1), rng.randint(1, size))}
        rooms = []
        for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
            if rooms and max(rooms) >= length:
                rooms.remove(room := max(rooms))
                rooms.append(room - length)
            else:
                rooms.append(size - length)
        assert abs(sum(c for c, _ in packing.patterns(histogram, size)) - len(rooms)) <= max(1, len(rooms) // 50)


def test_other_vocabularies_are_encoded_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encode = Tokenizer.from_file(path), packing.CachedTokenizer(path)
    assert not encode.by_word and packing.CachedTokenizer(packing.default_path()).by_word
    for t in [*STRANGE, "Two  Words\n"]:
        assert np.frombuffer(encode([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_odd_white_space():
    tokenizer, encode = Tokenizer.from_file(packing.default_path()), packing.CachedTokenizer(packing.default_path())
    rng = random.Random(3)
    signs = [*"\t\n\x0b\x0c\r \x85\xa0      　​﻿᠎", *"abéÉß'sT1.,ǅŉΣ"]
    for t in ("".join(rng.choices(signs, k=40)) for _ in range(300)):
        assert np.frombuffer(encode([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
