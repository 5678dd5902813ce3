import re

import pytest
import xxhash

from sigweave.llm import simhash

from .data import SCHEMA, corpus, documents


def fingerprint(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    rows = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in rows]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(ids, fps, bits):
    least = dict.fromkeys(fps)
    for f in fps:
        seen, stack = {f}, [f]
        while stack:
            x = stack.pop()
            for y in set(fps) - seen:
                if (x ^ y).bit_count() <= bits:
                    seen.add(y)
                    stack.append(y)
        least[f] = min((i for i, g in zip(ids, fps, strict=True) if g in seen and i is not None), default=None)
    return least


@pytest.mark.parametrize(("shingle", "bits", "bucket_max"), [(3, 2, 4096), (3, 2, 2), (5, 3, 4096)])
def test_components(spark, shingle, bits, bucket_max):
    rows = corpus(3)
    fps = [fingerprint(t, shingle) for _, t in rows]
    least = reachable([i for i, _ in rows], fps, bits)
    want = sorted(((i, f, least[f]) for (i, _), f in zip(rows, fps, strict=True)), key=str)
    got = simhash.near_components(documents(spark, rows), shingle=shingle, bits=bits, bucket_max=bucket_max).collect()
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("bucket_max", [4096, 1])
def test_links_lose_nothing(spark, bucket_max):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b for b in base}
    for _ in range(120):
        x = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    frame = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    edges = simhash.links(frame, 2, bucket_max)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    want = reachable([simhash.signed(x) for x in sorted(fps)], sorted(fps), 2)
    for x in fps:
        assert roots.get(simhash.signed(x), simhash.signed(x)) == want[x]


def test_empty(spark):
    assert simhash.near_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_too_many_bits_are_refused_whatever_the_rows(spark):
    with pytest.raises(ValueError, match="too many"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)
