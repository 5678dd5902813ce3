import math
import random

import numpy as np
import pytest

from sigweave.llm import near, simhash

from .test_near import alike, check, near_copies, shingles


def sets_at(similarity, size, n, seed):
    """n pairs of hash sets of about `size` at a Jaccard similarity: the hashes, run after run, and the sizes."""
    rng = np.random.default_rng(seed)
    both, alone = round(size * similarity), size - round(size * similarity)
    runs = []
    for _ in range(n):
        h = rng.integers(0, 1 << 63, size, np.uint64)
        runs += [h[: both + alone // 2], np.append(h[:both], h[both + alone // 2 :])]
    return np.concatenate(runs), np.array([len(x) for x in runs])


@pytest.mark.parametrize("size", [20, 1000])
def test_bits_differ_by_the_angle(size):
    fp = simhash.wide_fingerprints(*sets_at(0.8, size, 300, 1))
    apart = np.bitwise_count(fp[::2] ^ fp[1::2]).sum(axis=1)
    assert near.differing(0.8) == pytest.approx(math.acos(8 / 9) / math.pi)
    assert abs(apart.mean() - 512 * near.differing(0.8)) < 4 and apart.max() <= near.bound(0.8)
    unlike = np.bitwise_count(fp[:-2:2] ^ fp[2::2]).sum(axis=1)
    assert abs(unlike.mean() - 256) < 4 and unlike.min() > near.bound(0.8)


def test_a_fingerprint_is_of_its_own_text():
    h, count = sets_at(0.5, 50, 400, 2)
    whole, at = simhash.wide_fingerprints(h, count), np.cumsum(count) - count
    for i in (0, 255, 256, 799):
        assert (simhash.wide_fingerprints(h[at[i] : at[i] + count[i]], count[i : i + 1]) == whole[i]).all()
    assert (simhash.wide_fingerprints(h[:0], np.array([0, 0])) == 0).all()


def test_a_bucket_is_connected_as_by_all_pairs():
    """A group far above SMALL, chains and pairs among unrelated fingerprints."""
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, (600, 8), np.uint64)

    def changed(x, bits):
        out = np.unpackbits(x.view(np.uint8))
        out[rng.choice(512, bits, replace=False)] ^= 1
        return np.packbits(out).view(np.uint64)

    for i in range(1, 200):
        fp[i] = changed(fp[0], 30)
    for i in range(200, 260):
        fp[i] = changed(fp[i - 1], 60)
    for i in range(300, 400, 2):
        fp[i] = changed(fp[i + 1], 75)
    fp = fp[rng.permutation(600)]
    want = np.arange(600)
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2) <= near.bound(0.8))
    near._merge(want, i, j)
    got = near.bucket_labels(fp, rng.permutation(512), near.differing(0.8), near.bound(0.8))
    assert (want[got] == want).all()  # nothing that all pairs keep apart
    assert (np.bincount(want) > 1).sum() == 51 and (got == want).mean() > 0.99


@pytest.mark.parametrize("most", [1 << 19, 4])
def test_pairs_at_the_similarity_share_a_simhash_cluster(spark, monkeypatch, most):
    """In buckets held whole, and in parts of four rows."""
    monkeypatch.setattr(near, "MOST", most)
    rows = near_copies(6, 60)
    frame = spark.createDataFrame([(i, i, t) for i, t in rows], "doc_id long, th long, text string")
    signed = near.signatures(frame, 5).dropDuplicates(["node"]).localCheckpoint()
    keys = {}
    for r in near.clusters(signed, 0.8).collect():
        keys.setdefault(r.node, set()).add(r.key)
    texts = dict(rows)
    of = [(r.node, shingles(texts[r.doc_id])) for r in signed.collect()]
    pairs = [(u, v) for a, (u, x) in enumerate(of) for v, y in of[:a] if alike(x, y)]
    assert len(pairs) > 20 and all(keys[u] & keys[v] for u, v in pairs)


def test_parts_of_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(near, "MOST", 8)
    monkeypatch.setattr(near, "ROWS", 1)
    rng = random.Random(7)
    rows = near_copies(7, 60) + [(100, None), (101, " "), (102, "one"), (103, " ".join(rng.choices("abc", k=40)))]
    check(spark, rows, near.drop_near)
