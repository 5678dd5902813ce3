import random

import numpy as np

from sigweave.llm import decontamination as dc

from .data import SCHEMA, documents


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(rows, items):
    out = {}
    for i, t in rows:
        text = dc.normal(t or "")
        for item, x in items:
            known, body = dc.Benchmark([(item, x)]), dc.normal(x)
            if 0 < len(body) < dc.Q:
                if f" {body} " in f" {text} ":
                    out[i, item] = (1, 1, 0)
                continue
            hits = [e for s, k in zip(known.segments, known.edits, strict=True) if (e := least_edits("".join(map(chr, s)), text)) <= k]
            if hits:
                out[i, item] = (len(known.segments), len(hits), min(hits))
    return out


def find(known, points):
    segment, edits, end, _ = known.find(np.append(points, np.uint32(10)), np.array([0, len(points) + 1]))
    return segment, edits, end


def edit(rng, t, n):
    for _ in range(n):
        k = rng.randrange(len(t))
        t = rng.choice([t[:k] + t[k + 1 :], t[:k] + rng.choice("abé ") + t[k:], t[:k] + "x" + t[k + 1 :]])
    return t


def cases(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(2, 6))) for _ in range(80)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, say(n)) for i, n in enumerate([2, 3, 5, 10, 20, 30, 30, 45, 60, 80])] + [(20, "ab"), (21, ""), (22, None), (23, "abcdefgh")]
    rows = []
    for i in range(60):
        item = rng.choice(items[:10])[1]
        kind = rng.random()
        part = item if kind < 0.4 else edit(rng, item, rng.randint(1, max(1, len(item) // 8))) if kind < 0.8 else item[: len(item) // 2]
        rows.append((i, f"{say(rng.randint(0, 30))}, {rng.choice([part, part.upper(), part.replace(' ', ' -- ')])}. {say(rng.randint(0, 30))}"))
    return [*rows, (100, None), (101, ""), (102, items[4][1]), (103, "abcdefgh"), (104, "ab")], items


def test_against_brute_force(spark):
    rows, items = cases()
    benchmark = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (r.n_segments, r.n_found, r.edits) for r in dc.leaks(documents(spark, rows), benchmark).collect()}
    want = brute(rows, [(i, x or "") for i, x in items])
    assert got == want and len(want) > 30
    kept = dc.drop_leaks(documents(spark, rows), benchmark)
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows} - {i for i, _ in want})


def test_rows_are_judged_apart_whatever_the_partitions(spark):
    rng = random.Random(8)
    item = dc.normal(" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(20)))[:119]
    items = [(1, item), (2, "abcdefgh"), (3, "ab c"), (4, "zyxwvutsrq zyx")]
    rows = [(i, "abcdefgh") for i in range(6)] + [(10, item[:60]), (11, item[60:]), (12, item[:60]), (13, item[60:]), (14, item[30:89])]
    rows += [(20 + i, t) for i, t in enumerate(["x ab c y", "ab cd", "xab c", "zyxwvutsrq", "zyx", "zyxwvutsrq zyx", "", "zyxwvutsrqzyx", "AB--c"] * 4)]
    want = brute(rows, items)
    assert {k for k in want if k[1] == 2} == {(i, 2) for i in range(6)} and not [k for k in want if k[1] == 1]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 3, 8):
        got = dc.leaks(docs.repartition(parts), benchmark).collect()
        assert {(r.doc_id, r.item_id): (r.n_segments, r.n_found, r.edits) for r in got} == want and len(got) == len(want)


def test_very_long_text(spark):
    rng = random.Random(9)
    item = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40))
    long = " ".join("".join(rng.choices("ijklmnop", k=7)) for _ in range(150_000))
    docs = spark.createDataFrame([(1, f"{long} {item} {long}"), (2, long), (3, "short")], "doc_id long, text string")
    got = dc.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.edits, r.at > len(long)) for r in got] == [(1, 0, True)]


def test_rows_go_by_their_own_text(spark):
    item = " ".join(f"word{i}" for i in range(30))
    rows = [(1, item), (1, "clean"), (None, item), (None, "clean too"), (None, None), (2, "clean"), (2, "clean")]
    kept = dc.drop_leaks(documents(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "clean"), (None, "clean too"), (None, None), (2, "clean"), (2, "clean")], key=str)


def test_blocks_and_no_rows(spark, monkeypatch):
    rows, items = cases(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = dc.leaks(documents(spark, rows), benchmark).collect()
    monkeypatch.setattr(dc, "BLOCK", 500)
    assert sorted(dc.leaks(documents(spark, rows), benchmark).collect()) == sorted(one)
    assert dc.leaks(documents(spark, rows), benchmark.limit(0)).count() == 0
    assert dc.leaks(spark.createDataFrame([], SCHEMA), benchmark).count() == 0


def test_bands_hold_all_edits():
    rng = random.Random(3)
    for _ in range(200):
        item = "".join(rng.choices("abcdefgh", k=150))
        known = dc.Benchmark([(1, item)])
        text = "".join(rng.choices("abcdefgh", k=rng.randint(0, 200)))
        text = text + edit(rng, item[:120], rng.randint(0, 12)) + "zz"
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        segment, edits, _ = find(known, points)
        assert 0 in segment and min(edits[segment == 0]) == least_edits("".join(map(chr, known.segments[0])), text)


def test_excerpts_at_all_offsets():
    """Of any item a passage of PASSAGE characters, from whatever offset, also with SHORT // FEW edits."""
    rng = random.Random(4)
    say = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    sizes = [80, 81, 97, 119, 120, 121, 150, 181, 226, 394]
    items = [(i, dc.normal(say(2 * n))[:n].strip()) for i, n in enumerate(sizes)]
    items = [(i, t) for i, t in items if len(t) >= 80]
    known = dc.Benchmark(items)
    n = 0
    for item, text in items:
        for start in range(len(text) - 79):
            for part in (text[start : start + 80], edit(rng, text[start : start + 80], 3)):
                segment, _, _ = find(known, dc._points(f"{say(50)}{part}{say(50)}"))
                assert item in {known.item[s] for s in segment}, (item, start)
                n += 1
    assert n > 1000
    segment, _, _ = find(known, dc._points(say(100_000)))
    assert not len(segment)


def test_tails_of_items_at_the_ends_of_a_text():
    item = "".join(random.Random(6).choices("abcdefgh", k=400))
    known = dc.Benchmark([(1, item)])
    for cut in range(1, 120):
        for text in (item[cut:120], item[120 - cut : 240], item[:cut], item[60:180] + item[cut:120]):
            segment, edits, end = find(known, dc._points(text))
            assert all(least_edits("".join(map(chr, known.segments[s])), text) <= e <= known.edits[s] for s, e in zip(segment[:1].tolist(), edits[:1].tolist(), strict=True))
            assert (end <= len(text)).all()


def test_mapped_block_is_the_same(tmp_path):
    """A block read back from its file, also an empty one and one of short items only, finds what it found."""
    rows, items = cases(7)
    for some in ([(i, t or "") for i, t in items], [], [(1, "ab"), (None, "xyz")]):
        known = dc.Benchmark(some)
        known.write(f"{tmp_path}/block")
        again = dc.Benchmark.mapped(f"{tmp_path}/block")
        assert vars(known).keys() == vars(again).keys()
        assert all(np.array_equal(v, getattr(again, k)) for k, v in vars(known).items())
        for _, t in rows[:20]:
            text = dc.normal(t or "")
            if text:
                assert [x.tolist() for x in find(known, dc._points(text))] == [x.tolist() for x in find(again, dc._points(text))]


def test_a_large_block_holds_little_of_its_own(tmp_path):
    """A worker maps a block of a million characters; its own memory hardly grows."""
    import subprocess
    import sys

    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(5000)]
    dc.Benchmark([(i, " ".join(rng.choices(words, k=150))) for i in range(1000)]).write(f"{tmp_path}/block")
    code = f"""
import re, numpy as np
from sigweave.llm import decontamination as dc
own = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
before = own()
known = dc.Benchmark.mapped({f"{tmp_path}/block"!r})
points = dc._points("some words that no item has " * 200)
known.find(np.append(points, np.uint32(10)), np.array([0, len(points) + 1]))
print(own() - before)
"""
    assert float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 100
