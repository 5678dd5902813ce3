"""Quality classifier by attention-based multiple-instance learning (Ilse et al., 2018).

A document is a bag of passages of 64 words. Each passage is encoded (hashed byte pairs and word shapes, then a
learned layer); gated attention weighs the passages; the weighted sum is scored. Only documents have labels, so
the weights are learned from them. Training takes a bounded, documented sample: `sample` labelled ids by hash order, one
row of each, and MOST passages of a row at most, spread evenly over it. Scoring reads every passage of every document.

Defined results: null text is empty; an empty document is one passage without features and still gets a score;
rows that repeat are scored each; with no usable label, or labels of one class, every score is that class's
share (0.5 with none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Words, column, pick, ranges, slabs, text_of

PASSAGE = 64
PAIRS = 512
SHAPES = 8
WIDTH = PAIRS + SHAPES
#: Labelled rows to learn from, at most.
SAMPLE = 3000
#: Passages of a row to learn from, at most: with SAMPLE, 200 MB on the driver.
MOST = 32
#: Passages that are encoded at a time.
STEP = 1024

_KIND = np.zeros(256, np.int64)  # 1 lower-case letter, 2 upper, 3 digit, 4 other ASCII sign, 5 byte of a longer character
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[i for i in range(0x21, 0x7F) if not _KIND[i]]] = 4
_KIND[0x80:] = 5


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (float32, rows of WIDTH) and the number of passages of each document, 1 at least."""
    words = Words(data, bounds)
    n = np.diff(words.first)
    bags = np.maximum(1, -(-n // PASSAGE))
    base = np.cumsum(bags) - bags
    of_word = np.repeat(base, n) + ranges(n) // PASSAGE
    total = int(bags.sum())
    out = np.zeros((total, WIDTH), np.float32)
    if not len(of_word):
        return out, bags
    size = words.ends - words.starts
    inside = np.flatnonzero(words.solid)
    of_byte = np.repeat(of_word, size)
    byte = data[inside].astype(np.int64)
    # what follows a byte or a word in its own row: a row's end counts as a space, whatever row comes next
    follows = np.append(data, np.uint8(0x20))
    follows[bounds[1:]] = 0x20
    after = follows[inside + 1].astype(np.int64)
    after[SPACES[after]] = 0x20
    pair = ((byte * 256 + after) * 40_503 >> 4) % PAIRS
    counts = np.bincount(of_byte * PAIRS + pair, minlength=total * PAIRS).reshape(total, PAIRS)
    out[:, :PAIRS] = np.sqrt(counts)
    out[:, :PAIRS] /= np.maximum(1e-6, np.linalg.norm(out[:, :PAIRS], axis=1, keepdims=True))
    kinds = np.bincount(of_byte * 6 + _KIND[byte], minlength=total * 6).reshape(total, 6)
    letters = np.maximum(1, kinds.sum(axis=1))
    out[:, PAIRS : PAIRS + 5] = kinds[:, 1:] / letters[:, None]
    in_passage = np.maximum(1, np.bincount(of_word, minlength=total))
    out[:, PAIRS + 5] = kinds.sum(axis=1) / in_passage / 10
    out[:, PAIRS + 6] = np.bincount(of_word[size == 1], minlength=total) / in_passage
    ends_line = follows[words.ends] == 0x0A
    out[:, PAIRS + 7] = np.bincount(of_word[ends_line], minlength=total) / in_passage
    return out, bags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights; without any, `share` is the score of all."""

    weights: dict[str, np.ndarray]
    share: float = 0.5

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w, at = self.weights, np.cumsum(bags) - bags
        # in steps of passages, since in double precision all of a long text's features would be large
        h = np.concatenate([np.tanh(x[i : i + STEP].astype(w["encode"].dtype, copy=False) @ w["encode"] + w["encode_bias"]) for i in range(0, len(x), STEP)])
        t, s = np.tanh(h @ w["value"]), _sigmoid(h @ w["gate"])
        a = (t * s) @ w["attend"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, at), bags))
        a /= np.repeat(np.add.reduceat(a, at), bags)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["score_bias"])}

    def scores(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """In double precision."""
        exact = Model({k: v.astype(float) for k, v in self.weights.items()})
        return exact.forward(x, bags)["p"] if self.weights else np.full(len(bags), self.share)

    def settled(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Scores rounded, so that a row's doesn't show in what batch it was computed."""
        return self.scores(x, bags).round(9)


def gradients(model: Model, x: np.ndarray, bags: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss of labels y, by weight."""
    w, f, at = model.weights, model.forward(x, bags), np.cumsum(bags) - bags
    h, t, s, a, z = f["h"], f["t"], f["s"], f["a"], f["z"]
    d_out = (f["p"] - y) * weight
    wide = np.repeat(d_out[:, None] * w["score"], bags, axis=0)
    d_a = (wide * h).sum(axis=1)
    d_a = a * (d_a - np.repeat(np.add.reduceat(a * d_a, at), bags))
    d_g = d_a[:, None] * w["attend"]
    d_t, d_s = d_g * s * (1 - t * t), d_g * t * s * (1 - s)
    d_h = (a[:, None] * wide + d_t @ w["value"].T + d_s @ w["gate"].T) * (1 - h * h)
    return {"encode": x.T @ d_h, "encode_bias": d_h.sum(axis=0), "value": h.T @ d_t, "gate": h.T @ d_s, "attend": (t * s).T @ d_a, "score": z.T @ d_out, "score_bias": d_out.sum(keepdims=True)}


def train(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = 40, hidden: int = 48, gated: int = 24, rate: float = 0.004, decay: float = 1e-4, seed: int = 7) -> Model:
    """Weights learned by Adam on documents' labels y (0 or 1); both classes count the same."""
    if not len(y) or y.min() == y.max():
        return Model({}, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    init = lambda a, b: rng.normal(0, a**-0.5, (a, b)).astype(np.float32)
    w = {"encode": init(WIDTH, hidden) * 3, "encode_bias": np.zeros(hidden, np.float32), "value": init(hidden, gated), "gate": init(hidden, gated), "attend": np.zeros(gated, np.float32) + 0.1, "score": init(hidden, 1)[:, 0], "score_bias": np.zeros(1, np.float32)}
    model, at = Model(w), np.cumsum(bags) - bags
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            part = order[lo : lo + 64]
            b = bags[part]
            rows = np.repeat(at[part], b) + ranges(b)
            xs = x[rows]
            grads = gradients(model, xs, b, y[part], weight[part] / len(part))
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] -= (rate * (0.5 if epoch > epochs // 2 else 1) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + rate * decay * w[k]).astype(np.float32)
    return model


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), text_of("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, learn_from=None, most: int = MOST) -> Model:
    """The model of `sample` labelled ids at most, taken in hash order; of the rows of one id, that whose text has the
    least hash, and `most` of its passages. learn_from: a condition on doc_id that labelled rows must meet. The passages'
    features go to the driver: 2 kB each, sample * most of them at most."""
    marks = pick(labels, doc_id=column_of(labels, id_col), y=label_col).select(F.col("doc_id").cast("long"), F.col("y").cast("int")).where("doc_id is not null and y in (0, 1)")
    if learn_from is not None:
        marks = marks.where(learn_from)
    marks = marks.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            x, bags = passages(slab.data, slab.bounds)
            ends = np.cumsum(bags)
            blobs = [x[b - n : b][np.unique(np.linspace(0, n - 1, min(n, most)).round().astype(int))].tobytes() for b, n in zip(ends, bags, strict=True)]
            bags = np.minimum(bags, most)
            yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id"), slab.rows.column("y"), pa.array(bags.astype(np.int64)), pa.array(blobs, pa.binary())], names=["doc_id", "y", "n", "x"])

    # `sample` rows of two numbers: a bounded side
    chosen = _rows(docs, id_col, text_col).join(F.broadcast(marks), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = sorted(chosen.mapInArrow(run, "doc_id long, y int, n long, x binary").collect(), key=lambda r: r["doc_id"])
    if not got:
        return Model({})
    x = np.concatenate([np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, WIDTH) for r in got])
    return train(x, np.array([r["n"] for r in got]), np.array([r["y"] for r in got], np.float32))


def column_of(df: DataFrame, name: str) -> str:
    return name if name in df.columns else "doc_id"


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            x, bags = passages(slab.data, slab.bounds)
            yield pa.RecordBatch.from_arrays([slab.rows.column("doc_id"), pa.array(model.settled(x, bags), pa.float64())], names=["doc_id", "score"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs that score `least` or more, all columns, in one pass without a shuffle."""
    names = docs.columns
    at = column(docs, text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", text_of(f"c{at}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            good = model.settled(*passages(slab.data, slab.bounds)) >= least
            kept = slab.rows.filter(pa.array(good))
            yield kept.select([f"c{i}" for i in range(len(names))])

    schema = plain.drop("text").schema
    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
