"""Small tables that hold the awkward cases: nulls, empties, long texts, ties, repeats, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, keep_id string, `Text2` string, fp string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 30, 80, 200]))) for _ in range(n)]
    out = []
    for i in range(n):
        t = rng.choice(base)
        kind = rng.random()
        if kind < 0.2 and t:
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind < 0.35:
            t = t.replace(" ", rng.choice(["\n", "  ", " \t\n", "\x0b"]))
        elif kind < 0.45:
            t = t.upper()
        out.append((i * 3, t))
    out += [(1, None), (4, ""), (7, "   "), (10, None), (None, base[0]), (None, "only here"), (13, "tie"), (13, "tie"), (16, "one word")]
    out += [(5000, " ".join(rng.choices(vocabulary, k=30_000)))]
    return out
