import random
import re

import corpus_pipeline
from sigweave.llm import near

from .data import SCHEMA, corpus, documents


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(x, y):
    return x == y or bool(x and y) and len(x & y) >= 0.8 * len(x | y)


def groups(rows):
    sets, out, left = [shingles(t) for _, t in rows], [], set(range(len(rows)))
    while left:
        group, stack = set(), [left.pop()]
        while stack:
            i = stack.pop()
            group.add(i)
            new = {j for j in left if alike(sets[i], sets[j])}
            left -= new
            stack += new
        out.append(group)
    return out


def near_copies(seed=1, n=150):
    """Texts and copies of them at similarities from about 0.5 to 1."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(400)]
    texts = [rng.choices(words, k=rng.randint(30, 200)) for _ in range(25)]
    while len(texts) < n:
        t = list(rng.choice(texts))
        for _ in range(max(1, int(len(t) * rng.uniform(0, 0.05)))):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(t)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def check(spark, rows, drop):
    frame = documents(spark, rows)
    out = drop(frame)
    assert out.columns == frame.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    want = []
    for g in groups(rows):
        members = [rows[i] for i in g]
        ids = [i for i, _ in members if i is not None]
        kept = [m for m in got if m in members]
        assert kept and len(set(kept)) == 1 and kept[0][0] == (min(ids) if ids else None)
        want.append(kept[0])
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_all_pairs_at_the_similarity_and_no_others(spark):
    rows = near_copies()
    sets = [shingles(t) for _, t in rows]
    close = [(x, y) for a, x in enumerate(sets) for y in sets[:a] if 0.8 <= len(x & y) / len(x | y) < 0.9]
    below = [(x, y) for a, x in enumerate(sets) for y in sets[:a] if 0.7 <= len(x & y) / len(x | y) < 0.8]
    assert len(close) > 20 and len(below) > 20
    assert len(check(spark, rows, lambda docs: corpus_pipeline.drop_near(spark, docs, ""))) < len(rows)


def test_awkward_rows(spark):
    rows = corpus(4)
    rows += [(None, rows[0][1]), (13, rows[40][1]), (13, "tie again"), (5000, "one of the same id")]
    check(spark, rows, near.drop_near)
    assert near.drop_near(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_go_by_their_own_text(spark):
    rows = near_copies(3, 30)
    text = " ".join(f"w{i}" for i in range(100))
    mine = [(3, text), (7, text + " end"), (7, "an unrelated text of the same id"), (9, "two equal rows"), (9, "two equal rows"), (None, "alone"), (None, "alone")]
    got = check(spark, [(i + 100, t) for i, t in rows] + mine, near.drop_near)
    assert sorted((m for m in got if m[0] is None or m[0] < 100), key=str) == sorted([mine[0], mine[2], mine[3], mine[5]], key=str)


def test_copies_of_one_text_that_are_no_copies_of_each_other(spark, monkeypatch):
    """Every copy is linked to the text only, which is not the first of them; all comparisons but a few are with it."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    text = rng.choices(words, k=300)
    rows = []
    for i in range(60):
        t = list(text)
        for k in rng.sample(range(300), 5):
            t[k] = rng.choice(words)
        rows.append((i, " ".join(t)))
    rows[37] = (37, " ".join(text))
    sets = [shingles(t) for _, t in rows]
    assert all(alike(sets[37], s) for s in sets) and sum(alike(x, y) for x in sets for y in sets) < 60 * 60 // 2
    made, similar = [], near.similar
    monkeypatch.setattr(near, "similar", lambda pairs, *a: made.append(pairs.count()) or similar(pairs, *a))
    got = check(spark, rows, near.drop_near)
    assert len(got) == 1 and sum(made) < 60 * 6


def test_many_texts_below_the_similarity_make_few_pairs(spark, monkeypatch):
    """Texts that have four fifths of their words in common with all others, so a similarity of about 0.65."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    common = rng.choices(words, k=160)
    rows = [(i, " ".join([*common, *rng.choices(words, k=35)])) for i in range(80)]
    made, similar = [], near.similar
    monkeypatch.setattr(near, "similar", lambda pairs, *a: made.append(pairs.count()) or similar(pairs, *a))
    assert len(check(spark, rows, near.drop_near)) == 80 and made[-1] == 0 and sum(made) < 80 * 79 // 3


def test_rounds_change_nothing(spark, monkeypatch):
    rows = near_copies(5)
    want = check(spark, rows, near.drop_near)
    for rounds, slots in ((0, 4), (2, 1 << 18)):
        monkeypatch.setattr(near, "ROUNDS", rounds)
        monkeypatch.setattr(near, "SLOTS", slots)
        assert sorted(check(spark, rows, near.drop_near)) == sorted(want)


def test_buckets_with_several_groups(spark, monkeypatch):
    monkeypatch.setattr(near, "ROWS", 1)
    common = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{common} " + " ".join(f"g{i % 6}x{j}" for j in range(60)) + f" end{i}") for i in range(40)]
    assert len(check(spark, rows, near.drop_near)) == 6
