import random
import re
import string

import numpy as np

from sigweave.llm import quality

from .data import SCHEMA, corpus, documents


def words(rng, n):
    return [rng.choice(["the", "and", "water", "little", "house", "over", "Of", "seen"]) for _ in range(n)]


def labelled(seed, n):
    """Bad documents hold one bad stretch among good ones."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good, body = rng.random() < 0.6, words(rng, rng.choice([30, 150, 400]))
        if not good:
            at = rng.randrange(len(body))
            body[at : at + 30] = [w + rng.choice(["$$$", "%%%", "###"]) for w in words(rng, 70)]
        rows.append((i, " ".join(body)))
        labels.append((i, int(good)))
    return rows, labels


def test_learns_bags_and_scores_all(spark):
    rows, labels = labelled(1, 400)
    rows += [(1000, None), (1001, ""), (None, "the"), (3, rows[3][1]), (1002, " ".join(words(random.Random(0), 40_000)))]
    labels += [(5, None), (None, 1), (6, 7), (2000, 1)]
    docs = documents(spark, rows)
    frame = spark.createDataFrame([(i, y, "t") for i, y in labels], "doc_id long, quality int, text string")
    model = quality.fit(docs, frame, sample=300, learn_from="doc_id % 3 <> 1")
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert len(got) == len({i for i, _ in rows}) and all(0 <= s <= 1 for s in got.values())
    held = [(i, y) for i, y in labels[:400] if i % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.9
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted((i or -1) if i is not None else -1 for i, _ in rows if got[i] >= 0.5)
    again = quality.fit(docs, frame, sample=300, learn_from="doc_id % 3 <> 1")
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)


def test_without_two_classes(spark):
    """One class, no label, empty table."""
    docs = documents(spark, corpus(9, 10))
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(0, 1), (3, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.scored(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality.scored(docs, quality.fit(docs, ones)).collect()} == {1.0}
    assert quality.scored(spark.createDataFrame([], SCHEMA), quality.Model({})).count() == 0


def test_passages_cover_every_word():
    text = " ".join(f"w{i}" for i in range(1000)).encode()
    x, bags = quality.passages(np.frombuffer(text, np.uint8), np.array([0, len(text), len(text)]))
    assert bags.tolist() == [16, 1] and not x[16].any() and (np.abs(x[:16]).sum(axis=1) > 0).all()


def test_forward_is_attention_over_passages():
    """Against one document and one passage at a time, in plain loops."""
    rng = np.random.default_rng(3)
    bags = np.array([1, 4, 2])
    x = rng.normal(0, 1, (7, quality.WIDTH))
    model = quality.train(x.astype(np.float32), bags, np.array([0, 1, 0], np.float32), epochs=2)
    w, at, got = model.weights, 0, model.scores(x, bags)
    for n, p in zip(bags, got, strict=True):
        h = [np.tanh(row @ w["encode"] + w["encode_bias"]) for row in x[at : at + n]]
        e = [np.exp(w["attend"] @ (np.tanh(w["value"].T @ v) / (1 + np.exp(-(w["gate"].T @ v))))) for v in h]
        z = sum(a / sum(e) * v for a, v in zip(e, h, strict=True))
        assert abs(p - 1 / (1 + np.exp(-(z @ w["score"] + w["score_bias"][0])))) < 1e-6
        at += n


def test_gradients_by_differences():
    rng = np.random.default_rng(4)
    bags, y, weight = np.array([3, 1, 2]), np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])
    x = rng.normal(0, 1, (6, quality.WIDTH)) * 0.1
    model = quality.train(x.astype(np.float32), bags, y.astype(np.float32), epochs=1)
    model.weights = {k: v.astype(float) + rng.normal(0, 0.1, v.shape) for k, v in model.weights.items()}

    def loss():
        p = model.scores(x, bags)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    for name, grad in quality.gradients(model, x, bags, y, weight).items():
        flat, g = model.weights[name].reshape(-1), grad.reshape(-1)
        for k in rng.choice(len(flat), min(len(flat), 25), replace=False):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert abs((up - down) / (2 * step) - g[k]) < 1e-6 + 1e-4 * abs(g[k]), (name, k)


def test_sample_is_bounded(spark, monkeypatch):
    """Repeated labelled ids bring one row, long texts so many passages."""
    seen = {}
    monkeypatch.setattr(quality, "train", lambda x, bags, y, **_: seen.update(rows=len(y), passages=len(x)) or quality.Model({}))
    rows = [(1, f"text {i}") for i in range(200)] + [(2, " ".join(words(random.Random(0), 30_000))), (3, "x"), (None, "y")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    quality.fit(documents(spark, rows), labels)
    assert seen == {"rows": 3, "passages": 2 + quality.MOST}


def plain_features(text):
    """Of each passage of one text, in plain loops over its bytes."""
    rows = []
    spaces = b" \t\n\x0b\x0c\r"
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", text)]
    for at in range(0, max(1, len(words)), quality.PASSAGE):
        part = words[at : at + quality.PASSAGE]
        pairs, kinds, singles, line_ends = np.zeros(quality.PAIRS), np.zeros(6), 0, 0
        for a, b in part:
            for i in range(a, b):
                after = text[i + 1] if i + 1 < len(text) and text[i + 1] not in spaces else 0x20
                pairs[((text[i] * 256 + after) * 40_503 >> 4) % quality.PAIRS] += 1
                c = chr(text[i])
                kinds[5 if text[i] >= 0x80 else 1 if c in string.ascii_lowercase else 2 if c in string.ascii_uppercase else 3 if c in string.digits else 4 if 0x21 <= text[i] < 0x7F else 0] += 1
            singles += b - a == 1
            line_ends += text[b : b + 1] == b"\n"
        root = np.sqrt(pairs)
        n = max(1, len(part))
        rows.append([*(root / max(1e-6, np.linalg.norm(root))), *(kinds[1:] / max(1, kinds.sum())), kinds.sum() / n / 10, singles / n, line_ends / n])
    return np.array(rows)


def test_features_are_those_of_each_text_alone():
    texts = [(t or "").encode() for _, t in corpus(21, 60)] + [b"ends\n", b"\nstarts", b"x", b"\x00y", b"no space at the end", b"next"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    x, bags = quality.passages(data, np.cumsum([0, *map(len, texts)]))
    want = [plain_features(t) for t in texts]
    assert bags.tolist() == [len(w) for w in want]
    assert np.allclose(x, np.concatenate(want), atol=1e-6)


def test_score_is_the_rows_alone(spark):
    """Any order, 1, 3 and 40 partitions: the same model, the same scores, the same rows kept."""
    rows, labels = labelled(5, 150)
    rows += [(1000, "no end"), (1001, "x"), (1002, ""), (1003, None), (1004, "\nx"), (1005, " ".join(words(random.Random(1), 20_000)))]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    seen = []
    for n, order in ((1, 1), (1, -1), (3, 1), (40, -1)):
        docs = spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows[::order]], SCHEMA).repartition(n)
        model = quality.fit(docs, frame)
        seen.append((sorted(quality.scored(docs, model).collect()), sorted(r.doc_id for r in quality.keep_good(docs, model).collect())))
    assert all(s == seen[0] for s in seen[1:])
