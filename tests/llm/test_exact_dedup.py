import hashlib
import re
from collections import defaultdict

import pytest

from sigweave.llm import exact_dedup

from .data import SCHEMA, corpus, documents


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm, strict=True):
        groups[t].append(i)
    least = {t: min((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True)), key=str)


@pytest.mark.parametrize("name_bits", [64, 3])
def test_groups(spark, name_bits):
    rows = corpus()
    got = exact_dedup.exact_groups(documents(spark, rows), name_bits=name_bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_drop(spark):
    rows = corpus(2)
    out = exact_dedup.drop_exact(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    got = out.collect()
    assert len(got) == len({e[3] for e in expected(rows)})


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_exact(none).count() == 0


def test_chunks_depend_on_content():
    import numpy as np

    body = np.random.default_rng(0).integers(97, 123, 60_000).astype(np.uint8)
    moved = np.concatenate([np.frombuffer(b"an insertion at the front ", np.uint8), body])
    one = exact_dedup.cuts(exact_dedup.cut_candidates(body), 0, len(body))
    two = exact_dedup.cuts(exact_dedup.cut_candidates(moved), 0, len(moved))
    pieces = lambda data, ends: {data[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)}
    a, b = pieces(body, one), pieces(moved, two)
    assert len(a & b) >= 0.8 * len(a)
    assert max(map(len, a)) <= exact_dedup.MAX_CHUNK
