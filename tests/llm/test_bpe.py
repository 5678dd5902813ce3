import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sigweave.llm import bpe

from .data import SCHEMA, corpus, documents
from .test_packing import STRANGE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def ids_of(words, texts, **how):
    return [np.frombuffer(b, "<u4").tolist() for b in words.encode(texts, **how)]


def test_ids_and_texts_of_a_table(spark, library):
    rows = [r for r in corpus(11) if r[0] is not None] + [(9000 + i, t) for i, t in enumerate(STRANGE)] + [(9999, "ab" * 20_000 + "cd"), (None, "x")]
    out = bpe.decoded(bpe.encoded(documents(spark, rows)))
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in out.collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or -1, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_any_signs(library):
    """Random texts over all scripts, white space that only some take for it, runs on both sides of LONG."""
    rng, words = random.Random(5), bpe.Vocabulary(bpe.default_path())
    signs = [*"\t\n\x0b\x0c\r \x85\xa0 　​﻿᠎\x1c\x1f", *"abéÉß'sT1.,ǅŉΣ"]
    every = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choices("abcdeIN'st ", k=rng.choice([5, 100, 400]))) for _ in range(200)]
    texts += ["".join(rng.choices("in" if k % 2 else "abcde", k=bpe.LONG + rng.randint(-3, 3))) for k in range(100)]
    texts += ["".join(rng.choices(signs, k=60)) for _ in range(300)]
    texts += ["".join(map(chr, rng.choices(every, k=60))) for _ in range(300)]
    texts += [*STRANGE, "", "<|start<|endoftext|>oftext|>", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>"]
    for t, ids in zip(texts, ids_of(words, texts), strict=True):
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_cache_starts_anew(library):
    words = bpe.Vocabulary(bpe.default_path())
    texts = [t or "" for _, t in corpus(12, 40)] + ["w" * 500]
    for lo in (0, 3, 6, 0, 3):
        for t, ids in zip(texts[lo:], ids_of(words, texts[lo:], cache=20), strict=True):
            assert ids == library.encode(t, add_special_tokens=False).ids
    assert not any(len(w) > bpe.LONG for w in words.words | words.old)


def test_heap_and_scan_merge_alike():
    rng, words = random.Random(2), bpe.Vocabulary(bpe.default_path())
    for _ in range(200):
        run = bytes(rng.choices(b"theinaro", k=rng.randint(1, 60)))
        parts = [*words.inner[np.frombuffer(run[:-1], np.uint8)].tolist(), int(words.last[run[-1]])]
        assert bpe.merged(np.array([parts], np.int32), words.ranks) == [bpe.merged_by_heap(list(parts), words.ranks)]


def test_decodes_any_ids(spark, library):
    rows = [(1, [320, 49407, 0], "a"), (2, None, "b"), (3, [], "c"), (4, [99_999, -1, None, 320], "d"), (5, [320], None)]
    out = bpe.decoded(spark.createDataFrame(rows, "Ids2 int, ids array<int>, text string"), name="out")
    got = {r["Ids2"]: r["out"] for r in out.collect()}
    assert out.columns == ["Ids2", "ids", "text", "out"]
    assert got == {1: library.decode([320, 49407, 0], skip_special_tokens=False), 2: "", 3: "", 4: library.decode([320]), 5: library.decode([320])}


def test_empty_and_other_vocabularies(spark):
    import public_tokenizers

    assert bpe.decoded(bpe.encoded(spark.createDataFrame([], SCHEMA))).count() == 0
    with pytest.raises(ValueError, match="settings"):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_digests(spark, library):
    from sigweave.llm import registry

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.op12_rank_arrays(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
