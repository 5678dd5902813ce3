import random

from pyspark.sql import functions as F

from sigweave.llm import line_dedup

from .data import SCHEMA, corpus, documents


def near(a, b, least=line_dedup.LEAST):
    if min(len(a), len(b)) < least or abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(rows, least=line_dedup.LEAST):
    lines = [(i, n, " ".join(x.split())) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    first = {}
    for i, n, x in sorted(lines):
        first.setdefault(x, (i, n))
    gone = {x for x in first if x and any(first[y] < first[x] and near(x, y, least) for y in first if y)}
    out = {}
    for i, t in rows:
        out[i] = [n for n, x in enumerate(" ".join(x.split()) for x in (t or "").split("\n")) if x and (x in gone or first[x] < (i, n))]
    return out


def edited(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choices("aab é", k=rng.choice([3, 14, 15, 16, 17, 31, 32, 33, 64, 100, 127, 128, 129, 300]))) for _ in range(40)]
    rows = []
    for i in range(150):
        body = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(x) + 1)
                x = rng.choice([x[:k] + x[k + 1 :], x[:k] + rng.choice("ab") + x[k:], x[:k] + "c" + x[k + 1 :]])
            body.append(x)
        rows.append((i, "\n".join(body)))
    return rows


def test_against_brute_force(spark):
    rows = edited() + [(900, None), (901, ""), (902, "a\n\n \na\n a "), (903, "x" * 5_000), (904, "x" * 5_001)]
    got = line_dedup.judged(documents(spark, rows)).collect()
    assert {r.doc_id: r.removed for r in got} == brute(rows)
    assert all(r.n_removed == len(r.removed) for r in got) and sum(r.n_removed for r in got) > 100


def test_short_lines_too(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join("".join(rng.choices("abcdefghijk", k=rng.choice([1, 2, 3, 5, 8, 15, 16, 17, 31, 32, 33]))) for _ in range(3))) for i in range(60)]
    rows += [(100 + i, "\n".join(x[:k] + "z" + x[k + i % 2 :] for x in t.split("\n") for k in [rng.randrange(len(x) + 1)])) for i, t in rows]
    for least in (1, 4):
        got = line_dedup.judged(documents(spark, rows), least=least).collect()
        assert {r.doc_id: r.removed for r in got} == brute(rows, least)


def test_many_rows_without_id(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choices("abc", k=40)) for _ in range(30)]
    rows = [(None, "\n".join(rng.sample(lines, 3))) for _ in range(100)] + [(5, lines[0] + "x"), (5, lines[1]), (5, lines[1])]
    got = line_dedup.judged(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    named = sorted(r.n_removed for r in got if r.doc_id == 5)
    assert named == [0, 0, 1] and sum(r.n_lines - r.n_removed for r in got if r.doc_id is None) == 28


def test_very_long_lines(spark):
    rng = random.Random(7)
    x = "".join(rng.choices("abcdef", k=200_000))
    rows = [(1, x), (2, x[:77_777] + x[77_778:]), (3, x[:99_999] + "Z" + x[100_000:]), (4, x[:50] + "ZZ" + x[52:]), (5, x[::-1])]
    got = line_dedup.judged(documents(spark, rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}


def test_within_one_edit():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(2))
        assert line_dedup.within_one(a, b) == near(a, b, 0)


def test_variants_are_those_of_the_shorter_line():
    line = "".join(random.Random(1).choices("abé", k=50))
    whole = lambda x: next(line_dedup.variants(x, 9, 0, len(x)))[0]
    for v, at in line_dedup.variants(line, 9, 0, len(line)):
        assert v == whole(line if at < 0 else line[:at] + line[at + 1 :])


def test_repeats_and_no_rows(spark):
    got = line_dedup.judged(documents(spark, corpus(5)))
    assert got.count() == len(corpus(5))
    tie = got.where(F.col("doc_id") == 13).collect()
    assert sorted(r.n_removed for r in tie) == [0, 1]
    assert line_dedup.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_segments_of_edited_lines_meet():
    rng = random.Random(1)
    for _ in range(3000):
        x = "".join(rng.choices("ab", k=rng.randint(16, 300)))
        k = rng.randrange(len(x))
        y = rng.choice([x[:k] + x[k + 1 :], x[:k] + "c" + x[k:], x[:k] + "c" + x[k + 1 :]])
        for s in (line_dedup.COARSE, line_dedup.FINE):
            assert {k for k, _, _ in line_dedup.segments(x, s)} & {k for k, _, _ in line_dedup.segments(y, s)}
