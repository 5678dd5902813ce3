import hashlib
import random
import re

from sigweave.llm import substring_dedup

from .data import SCHEMA, corpus, documents


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        if i is not None:
            for k in range(len(w) - 49):
                x = tuple(w[k : k + 50])
                first[x] = min(first.get(x, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                keep[k : k + 50] = [False] * 50
        text = " ".join(x for x, y in zip(w, keep, strict=True) if y)
        out.append((i, len(w), keep.count(False), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choices(vocabulary, k=n) for n in (49, 50, 51, 60, 75, 120, 200, 50, 50)]
    rows = []
    for i in range(150):
        body = []
        for _ in range(rng.randint(0, 5)):
            s = rng.choice(shared)
            a = rng.randint(0, max(0, len(s) - 40)) if rng.random() < 0.4 else 0
            body += rng.choices(vocabulary, k=rng.randint(0, 40)) if rng.random() < 0.6 else []
            body += s[a:] if rng.random() < 0.8 else s[: len(s) - 5]
        rows.append((i * 2, rng.choice([" ", "\n", "  "]).join(body)))
    rows += [(301, " ".join(["the"] * 130)), (303, " ".join(["the"] * 60)), (305, " ".join(["the", "cat"] * 60)), (307, " ".join(["the", "cat"] * 40))]
    return rows + [(rows[3][0], rows[7][1]), (rows[3][0], rows[3][1]), (None, rows[9][1])]


def test_against_brute_force(spark):
    for rows in (passages(), corpus(12)):
        got = substring_dedup.cut_repeats(documents(spark, rows)).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_keys_that_collide(spark):
    rows = passages(9)
    for bits in (2, 7):
        assert rows_of(substring_dedup.cut_repeats(documents(spark, rows), key_bits=bits)) == brute(rows)


def test_words_whose_polynomial_hashes_collide(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    around = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([*around[:30], word, *around[30:]])), (2, " ".join([*around[:30], word.translate(str.maketrans("ab", "ba")), *around[30:]]))]
    got = rows_of(substring_dedup.cut_repeats(documents(spark, rows)))
    assert got == brute(rows) and [r[2] for r in got] == [0, 0]


def test_partitions_do_not_matter(spark):
    rows = passages(10)
    docs = documents(spark, rows)
    assert rows_of(substring_dedup.cut_repeats(docs.repartition(1))) == rows_of(substring_dedup.cut_repeats(docs.repartition(8))) == brute(rows)


def test_factors_end_where_words_part():
    mine = [b"%d" % i for i in range(200)]
    other = [*mine[:120], b"x", *mine[121:]]
    factors, odd = substring_dedup.parse(mine, [(0, 151, other)])
    assert factors == [(0, 120), (121, 200)] and odd == list(range(71, 121))


def test_empty(spark):
    assert substring_dedup.cut_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
