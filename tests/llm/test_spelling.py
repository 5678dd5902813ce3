import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sigweave.llm import spelling

from .data import SCHEMA, corpus, documents


def plain_words(rows, every=31, least=7):
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, least_n=2, ratio=10):
    words = {w: n for w, n in counts.items() if n >= least_n}
    form, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
        out[w] = (n, len(near))
    rows = set()
    for w, (n, n_near) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, n_near, words[form[w]] if form[w] else None))
    return rows


def misspelled(seed, n=150):
    """Chains of forms, ties, accents on both sides of the range, capitals, doubled letters, a very long word."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcéÿÀ", k=rng.randint(6, 9))) for _ in range(25)] + ["aaaaaaaa", "abababab"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = stems[min(len(stems) - 1, int(rng.expovariate(0.2)))]
            for _ in range(rng.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:at] + (rng.choice("abz×") if kind else "") + w[at + (kind < 2) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "\n", "1", ", Ā"]).join(words)))
    chain = " ".join(["chainzzab"] * 3 + ["chainzza"] * 45 + ["chainzz"] * 600)
    return rows + [(899, chain), (None, "Nullidword Nullidword"), (900, None), (901, ""), (902, "x" * 3000 + " " + "x" * 3001), (903, "x" * 3000 + " " + "x" * 3001), (5, rows[5][1])]


@pytest.mark.parametrize("bits", [None, 1 << 15])
def test_variants_by_brute_force(spark, bits):
    rows = misspelled(1)
    out = spelling.variants(spelling.counted(documents(spark, rows), every=31), bits=bits)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_words(rows))
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(r[1] not in (None, r[2]) for r in want) and sum(r[4] for r in want) > 100


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 10)
    rows = corpus(4, 60) + misspelled(2, 20)
    for every, least in ((31, 7), (None, 1), (2, 3)):
        got = spelling.counted(documents(spark, rows), every=every, least=least).collect()
        assert len(got) == len({r.word for r in got}) and {r.word: r.n for r in got} == plain_words(rows, every, least)


def test_edits_are_all_and_distinct():
    alphabet = "abcé"
    for word in ("aabca", "é", "aaaa", "abcabc"):
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in alphabet}
        want |= {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in alphabet}
        want.discard(word)
        made = np.concatenate([k for _, _, k in spelling.edits([word.encode("latin-1")], alphabet.encode("latin-1"))])
        assert sorted(made.tolist()) == sorted(spelling.keys([w.encode("latin-1") for w in want]).tolist())


def test_equal_keys_of_other_words(spark, monkeypatch):
    """Keys of 7 bits: nearly every candidate meets words that it isn't."""
    whole = spelling.mix
    monkeypatch.setattr(spelling, "mix", lambda x: whole(x) & np.uint64(127))
    words = plain_words(misspelled(3, 60))
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    key = [(w, n, int(spelling.keys([w.encode("latin-1")]).view(np.int64)[0])) for w, n in words.items() if n >= 2]
    assert len({k for _, _, k in key}) < len(key)
    got = {(r.word, r.near, r.near_n) for r in spelling.near_words(spark.createDataFrame(key, "word string, n long, key long")).collect()}
    assert frame.count() and got <= {(a, b, words[b]) for a, _, _ in key for b, _, _ in key if one_edit(a, b)}


def test_empty(spark):
    assert spelling.variants(spelling.counted(spark.createDataFrame([], SCHEMA))).count() == 0
    assert spelling.variants(spelling.counted(documents(spark, [(1, "alone once")]))).count() == 0
