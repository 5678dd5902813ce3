import math
import random

import numpy as np
import pytest

from sigweave.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, `Label2` int"


def whole(v, scale=256):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def plain(rows, every, positives=5, negatives=10, least=30, most=90):
    once = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = whole(v)
        key = (y, np.array(q, float).tobytes(), q)
        once[i] = min(once.get(i, key), key)
    dot = lambda a, b: max(-(2**56), min(2**56, sum(x * y for x, y in zip(a, b))))  # noqa: B905, E731  the shorter one has zeros
    out = set()
    for a, (ya, _, va) in once.items():
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, y) for i, (y, _, v) in once.items())
        for p, pid, _ in [s for s in scored if s[2] == ya and s[1] != a][:positives]:
            fits = [(n, i) for n, i, y in scored if y != ya and least * -p <= 100 * -n <= most * -p]
            out |= {(a, pid, k + 1, i, -p, -n) for k, (n, i) in enumerate(fits[:negatives])}
    return out


def table(seed, n=400, d=12, labels=4):
    """Clusters, ties, copies, one label with a third of the rows, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(0, 0.3, d) if rng.random() < 0.7 else rng.integers(-2, 3, d) / 8
        rows.append((i, [float(x) for x in v], 0 if rng.random() < 0.33 else int(rng.integers(labels))))
    same = rows[3][1]
    rows += [(n + i, same, i % 2) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    rows += [(None, same, 1), (5000, None, 1), (5010, same, None), (5020, [nan] * d, 0), (5030, [*same[1:], inf], 0), (5040, [None, *same[1:]], 0), (5050, [], 1), (5060, same[:5], 2), (5070, [*same, 0.5], 2), (7, same, 1), rows[8], (5080, [0.0] * d, 0), (5090, [-0.0] * d, 1)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("how", [{}, {"chunk": 37, "group": 5, "leaf": 3}])
def test_by_brute_force(spark, how):
    rows = table(1)
    out = hn.hard_negatives(frame(spark, rows), anchors="vec_id % 10 = 0", **how)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, 10)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


def test_other_numbers(spark):
    """Few rows of a label, windows with negative bounds, other counts and shares."""
    rows = [(i, [math.sin(i * k) for k in range(1, 5)], i % 17) for i in range(60)]
    out = hn.hard_negatives(frame(spark, rows), anchors="vec_id % 3 = 0", positives=2, negatives=3, least=-50, most=100, leaf=2, chunk=16)
    assert {tuple(r) for r in out.collect()} == plain(rows, 3, 2, 3, -50, 100)


@pytest.mark.parametrize("size", [40.0, 1e5, 1e8, 3e38])
def test_large_components(spark, size):
    """Products in single, double and whole numbers; what is beyond 2**56 counts as that."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-size, size) for _ in range(6)], i % 3) for i in range(40)]
    got = {tuple(r) for r in hn.hard_negatives(frame(spark, rows), anchors="vec_id % 5 = 0", leaf=4).collect()}
    assert got == plain(rows, 5)


def test_nodes_hold_their_rows():
    rng = np.random.default_rng(2)
    vectors, labels = rng.integers(-9, 9, (300, 5)).astype(float), rng.integers(0, 3, 300)
    f = hn.Forest.build(np.arange(300), labels, vectors, 8)
    for i in range(len(f.start)):
        part = slice(f.start[i], f.end[i])
        assert (np.linalg.norm(f.vectors[part] - f.centre[i], axis=1) <= f.radius[i] + 1e-9).all() and set(labels[f.ids[part]]) == {f.label[i]}
        if f.left[i]:
            assert (f.start[f.left[i]], f.end[f.left[i]], f.end[f.right[i]]) == (f.start[i], f.start[f.right[i]], f.end[i])
        else:
            assert f.end[i] - f.start[i] <= 8
    again = hn.Forest.unpacked(f.packed())
    assert all(np.array_equal(x, getattr(again, k)) for k, x in vars(f).items())


def test_prunes_groups_of_anchors():
    """Where vectors lie in clusters, few pairs of rows are scored, and the result is that of all."""
    rng = np.random.default_rng(3)
    centre = rng.integers(-2000, 2000, (8, 8))
    vectors = (centre[rng.integers(0, 8, 2000)] + rng.integers(-20, 20, (2000, 8))).astype(float)
    ids, labels = np.arange(2000), np.zeros(2000, np.int64)
    anchors, all_rows = hn.Forest.build(ids[::10], labels[::10], vectors[::10], 4), hn.Forest.build(ids, labels, vectors, 4, 6)
    best = hn.Best(anchors, np.full((200, 1), -(2**61)), np.full((200, 1), 2**61), 5)
    hn.search(best, all_rows, True)
    scored, every = hn.search(best, all_rows, True)  # what is known prunes; meeting rows again would double them
    assert scored < every / 5
    first = hn.Best(anchors, best.low, best.high, 5)
    hn.search(first, all_rows, True)
    for i, a in enumerate(anchors.ids):
        score = vectors @ vectors[a]
        order = [j for j in np.lexsort((ids, -score)) if j != a][:5]
        assert first.id[i, 0].tolist() == order and first.score[i, 0].tolist() == score[order].tolist()


def test_no_anchor_and_no_row(spark):
    rows = table(5, 50)
    assert hn.hard_negatives(frame(spark, rows), anchors="vec_id < 0").count() == 0
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = [(0, [1.0], 1), (1, [1.0], 2)]
    assert hn.hard_negatives(frame(spark, alone)).count() == 0
