import random

from tokenizers import Tokenizer

import corpus_pipeline
from sigweave.llm import decontamination, packing, quality
from sigweave.llm.common import table

from .test_near import groups
from .test_quality import labelled, words


def test_run_against_brute_force(spark, tmp_path):
    """Every stage by plain Python on what its predecessor kept, but for the learned scores."""
    rows, labels = labelled(3, 120)
    rng = random.Random(8)
    item = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40))
    rows += [(500 + i, rows[i][1].replace(" ", "\n \t", 5)) for i in range(0, 40, 3)]  # copies but for white space
    long = [(i, t.split(" ")) for i, t in rows[:60] if len(t.split(" ")) > 300]
    rows += [(600 + i, " ".join([*w[:100], "another", *w[101:]])) for i, w in long]  # near copies
    rows += [(700 + i, " ".join([*words(rng, 60), item, *words(rng, 60)])) for i in range(3)] + [(800, None), (801, ""), (3, rows[5][1] + " and more of it")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = table(spark, str(tmp_path), "documents")
    model = quality.fit(docs, table(spark, str(tmp_path), "labels"))
    good = quality.scored(docs, model).collect()
    assert len(good) == len(rows)
    texts = {(r.doc_id, r.text) for r in corpus_pipeline.keep_good(spark, docs, str(tmp_path)).collect()}
    kept = [r for r in rows if r in texts]
    assert sorted(r.doc_id for r in good if r.score >= 0.5) == sorted(i for i, _ in kept) and 0 < len(kept) < len(rows)
    first = {}
    for i, t in sorted(kept, key=lambda r: r[0]):
        first.setdefault(" ".join((t or "").split()), (i, t))
    once = list(first.values())
    near = [min((once[k] for k in g), key=lambda r: r[0]) for g in groups(once)]
    clean = [r for r in near if item not in decontamination.normal(r[1] or "")]
    assert len(kept) > len(once) > len(near) > len(clean) > 30

    tokenizer = Tokenizer.from_file(packing.default_path())
    want = sorted((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in clean)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(n for _, n in want)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near-dedup", "benchmark decontamination", "packing"]
