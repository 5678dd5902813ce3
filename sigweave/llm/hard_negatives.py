"""Hard-negative mining by dual-tree search (Gray and Moore; inner products after Curtin and Ram).

A group of anchors and a chunk of candidates each have trees, one a label: nodes are balls around their vectors' mean,
split at the median of their widest component. A pair of an anchor node and a candidate node has an interval that holds
all its inner products; a pair whose interval lies below what every anchor of the node still needs, or above what any may
take, is pruned with all pairs under it. Pairs of leaves that remain are scored exactly, in whole numbers.

Spark deals the work: candidate chunks of CHUNK rows are made once, without regard to label, so a label of any share
is spread evenly; each group of GROUP anchors meets every chunk, in tasks that read their chunks one after another and
keep the best so far, which is what the next chunk must beat. Groups and chunks are the blocks of a stated query set
against all rows.

Two rounds: each anchor's best rows of its own label (positives), then, for each of them, the best rows of other
labels whose score lies in a window that the positive's score sets.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part, also not as
anchors. Of rows that share an id, the one with the least label, then vector (as bytes) takes part. A shorter vector
is filled up with zeros; an empty one scores 0 with all. Scores beyond 2**56 either way are taken as 2**56. Of rows of one
label with the same vector only the smallest ids can be among the first, so others don't enter a chunk's tree.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, pick, ranges, written

#: Candidates of a chunk, anchors of a group, rows of a leaf (of either).
CHUNK, GROUP, LEAF = 8192, 4096, 64

_LEAST, _MOST = -(2**62), 2**62
_LIMIT = 2**56


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str | Column, scale: int) -> DataFrame:
    """vec_id, label, v (whole numbers as doubles, in bytes) of the rows that take part, once each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(pa.list_(pa.float64()))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(lists.flatten(), np.nan).to_numpy()
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            ok = (bad[ends] == bad[ends - size]) & np.asarray(lists.is_valid()) & np.asarray(batch.column("vec_id").is_valid()) & np.asarray(batch.column("label").is_valid())
            data = np.floor(flat[np.repeat(ok, size)] * scale) + 0.0  # no minus zero: equal vectors have equal bytes
            at = np.concatenate([[0], np.cumsum(8 * size[ok])])
            v = pa.Array.from_buffers(pa.large_binary(), int(ok.sum()), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(keep), batch.column("label").filter(keep), v], names=["vec_id", "label", "v"])

    label = label_col if isinstance(label_col, Column) else F.col(label_col)
    named = rows.withColumns({"sigweave label": label}) if isinstance(label_col, Column) else rows
    taken = pick(named, vec_id=id_col, label="sigweave label" if isinstance(label_col, Column) else label_col, v=vector_col)
    taken = taken.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<double>").alias("v"))
    return taken.mapInArrow(run, "vec_id long, label long, v binary").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


@dataclass
class Forest:
    """Rows in the order of their leaves, and the nodes of the trees: parents before children."""

    ids: np.ndarray
    vectors: np.ndarray
    label: np.ndarray  # of nodes, as all below
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray  # 0 for a leaf
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    roots: np.ndarray
    order: np.ndarray  # of the rows as given

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int, copies: int | None = None) -> Forest:
        """copies: of the rows of one label with one vector, those with so many smallest ids are enough."""
        order = np.lexsort((ids, labels))
        if copies:
            raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, max(1, vectors.shape[1] * vectors.itemsize)))).reshape(-1) if vectors.shape[1] else np.zeros(len(ids), "V1")
            _, same = np.unique(raw, return_inverse=True)
            order = np.lexsort((ids, same, labels))
            new = np.flatnonzero(np.concatenate([[True], (np.diff(same[order]) != 0) | (np.diff(labels[order]) != 0)]))
            order = order[ranges(np.diff(np.append(new, len(order)))) < copies]
        edges = np.flatnonzero(np.concatenate([[True], np.diff(labels[order]) != 0, [True]]))
        nodes: list[tuple] = []
        todo = [(int(a), int(b), -1, 0) for a, b in zip(edges, edges[1:], strict=False)][::-1]
        children, roots = {}, []
        while todo:
            a, b, parent, side = todo.pop()
            me, part = len(nodes), vectors[order[a:b]]
            if parent >= 0:
                children[parent, side] = me
            else:
                roots.append(me)
            centre = part.mean(axis=0)
            radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            nodes.append((labels[order[a]], a, b, centre, radius))
            width = part.max(axis=0) - part.min(axis=0) if part.shape[1] else np.zeros(1)
            if b - a > leaf and width.max() > 0:
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, width.argmax()], half)]
                todo += [(a + half, b, me, 1), (a, a + half, me, 0)]
        n, d = len(nodes), vectors.shape[1]
        column = lambda i, kind: np.array([x[i] for x in nodes], kind).reshape(n, -1) if i == 3 else np.array([x[i] for x in nodes], kind)
        side = lambda s: np.array([children.get((i, s), 0) for i in range(n)], np.int64)
        return Forest(ids[order], vectors[order], column(0, np.int64), column(1, np.int64), column(2, np.int64), side(0), side(1), column(3, float).reshape(n, d), column(4, float), np.array(roots, np.int64), order)

    def widened(self, d: int) -> Forest:
        """With vectors of d components."""
        add = d - self.vectors.shape[1]
        if add > 0:
            self.vectors, self.centre = np.pad(self.vectors, ((0, 0), (0, add))), np.pad(self.centre, ((0, 0), (0, add)))
        return self

    def packed(self) -> bytes:
        out = io.BytesIO()
        small = np.abs(self.vectors).max(initial=0) <= 2**24
        np.savez(out, **vars(self) | {"vectors": self.vectors.astype(np.float32) if small else self.vectors})
        return out.getvalue()

    @staticmethod
    def unpacked(body: bytes) -> Forest:
        with np.load(io.BytesIO(body)) as f:
            return Forest(**{k: f[k] for k in f.files})


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, by the narrowest kind of number that holds them."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < 2**53:
        return a.astype(float) @ b.astype(float).T
    whole = lambda x: np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
    return np.clip(whole(a) @ whole(b).T, -_LIMIT, _LIMIT).astype(np.int64)


class Best:
    """Of each anchor (in its forest's order) and window [low, high]: the first k rows met so far."""

    def __init__(self, forest: Forest, low: np.ndarray, high: np.ndarray, k: int):
        self.forest, self.low, self.high, self.k = forest, low, high, k
        self.score = np.full((*low.shape, k), _LEAST, np.int64)
        self.id = np.full((*low.shape, k), 2**63 - 1, np.int64)

    def needs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each node: the least score that any of its anchors and windows can use, and the most."""
        f, n = self.forest, len(self.forest.start)
        row_low = np.maximum(self.low, self.score[:, :, -1])
        row_low = np.where(row_low > self.high, _MOST, row_low)
        row_low, row_high = row_low.min(axis=1, initial=_MOST), np.where(self.low > self.high, _LEAST, self.high).max(axis=1, initial=_LEAST)
        low, high = np.empty(n, float), np.empty(n, float)
        for i in range(n):
            low[i], high[i] = row_low[f.start[i] : f.end[i]].min(), row_high[f.start[i] : f.end[i]].max()
        return low, high

    def meet(self, node: int, ids: np.ndarray, scores: np.ndarray, other_than_self: bool) -> None:
        a, b = int(self.forest.start[node]), int(self.forest.end[node])
        if scores.dtype == np.int64:
            none, fit = _LEAST, lambda x: x[:, None]
        else:  # bounds in the scores' own kind of number, cut to what they can reach
            top = float(np.abs(scores).max(initial=0)) + 1
            none, fit = -top, lambda x: np.clip(x, -top, top).astype(scores.dtype)[:, None]
        other = ids != self.forest.ids[a:b, None] if other_than_self else None
        for w in range(self.low.shape[1]):
            taken = (scores >= fit(np.maximum(self.low[a:b, w], self.score[a:b, w, -1]))) & (scores <= fit(self.high[a:b, w]))
            if other is not None:
                taken &= other
            taken[self.low[a:b, w] > self.high[a:b, w]] = False
            if taken.sum() > 4 * self.k * (b - a) and scores.shape[1] > self.k:
                kept = np.where(taken, scores, none)
                taken &= scores >= np.partition(kept, -self.k, axis=1)[:, -self.k, None]
            row, col = np.nonzero(taken)
            if not len(row):
                continue
            touched = np.unique(row)
            row = np.concatenate([row, np.repeat(touched, self.k)])
            score = np.concatenate([scores[taken].astype(np.int64), self.score[a + touched, w].reshape(-1)])
            found = np.concatenate([ids[col], self.id[a + touched, w].reshape(-1)])
            order = np.lexsort((found, -score, row))
            row, score, found = row[order], score[order], found[order]
            rank = ranges(np.unique(row, return_counts=True)[1])
            first = rank < self.k
            self.score[a + row[first], w, rank[first]], self.id[a + row[first], w, rank[first]] = score[first], found[first]


def search(best: Best, candidates: Forest, same_label: bool) -> tuple[int, int]:
    """Both trees at once: pairs of nodes, level by level. Returns the pairs of rows that were scored, and all."""
    anchors = best.forest
    d = max(anchors.vectors.shape[1], candidates.vectors.shape[1])
    anchors.widened(d)
    candidates.widened(d)
    low, high = best.needs()
    norm_a, norm_c = np.linalg.norm(anchors.centre, axis=1), np.linalg.norm(candidates.centre, axis=1)
    a, c = np.repeat(anchors.roots, len(candidates.roots)), np.tile(candidates.roots, len(anchors.roots))
    meant = (anchors.label[a] == candidates.label[c]) == same_label
    a, c = a[meant], c[meant]
    every, leaves = int(((anchors.end - anchors.start)[a] * (candidates.end - candidates.start)[c]).sum()), []
    while len(a):
        middle = np.einsum("ij,ij->i", anchors.centre[a], candidates.centre[c])
        reach = anchors.radius[a] * norm_c[c] + candidates.radius[c] * norm_a[a] + anchors.radius[a] * candidates.radius[c]
        reach += 1e-3 + 1e-9 * (np.abs(middle) + reach)  # what rounding may take
        kept = (middle + reach >= low[a]) & (middle - reach <= high[a])
        a, c = a[kept], c[kept]
        a_leaf, c_leaf = anchors.left[a] == 0, candidates.left[c] == 0
        leaves.append((a[a_leaf & c_leaf], c[a_leaf & c_leaf]))
        going = ~(a_leaf & c_leaf)
        a, c, a_leaf, c_leaf = a[going], c[going], a_leaf[going], c_leaf[going]
        a_sides = [np.where(a_leaf, a, s[a]) for s in (anchors.left, anchors.right)]
        c_sides = [np.where(c_leaf, c, s[c]) for s in (candidates.left, candidates.right)]
        pairs = [(x, y, ~(a_leaf & bool(i)) & ~(c_leaf & bool(j))) for i, x in enumerate(a_sides) for j, y in enumerate(c_sides)]
        a, c = np.concatenate([x[ok] for x, _, ok in pairs]), np.concatenate([y[ok] for _, y, ok in pairs])
    scored = 0
    if leaves:
        a, c = (np.concatenate(x) for x in zip(*leaves, strict=True))
        order = np.argsort(a, kind="stable")
        a, c = a[order], c[order]
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(a) != 0, [True]])) if len(a) else []
    for at, to in zip(bounds, bounds[1:], strict=False):
        size = (candidates.end - candidates.start)[c[at:to]]
        rows = np.repeat(candidates.start[c[at:to]], size) + ranges(size)
        node = int(a[at])
        scored += len(rows) * int(anchors.end[node] - anchors.start[node])
        best.meet(node, candidates.ids[rows], products(anchors.vectors[anchors.start[node] : anchors.end[node]], candidates.vectors[rows]), same_label)
    return scored, every


def _matrix(cells: list[bytes]) -> np.ndarray:
    """Vectors from bytes, the shorter ones filled up with zeros."""
    size = np.array([len(c) // 8 for c in cells], np.int64)
    out = np.zeros((len(cells), int(size.max(initial=0))))
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(cells), float)
    return out


def chunks(rows: DataFrame, copies: int, chunk: int = CHUNK, leaf: int = LEAF) -> DataFrame:
    """chunk (a number of its own), body: the rows of each partition in forests of `chunk` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId(), 0, []

        def forest(part: pa.Table) -> pa.RecordBatch:
            body = Forest.build(part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v").to_pylist()), leaf, copies).packed()
            return pa.RecordBatch.from_arrays([pa.array([task << 32 | made]), pa.array([body], pa.binary())], names=["chunk", "body"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= chunk:
                whole = pa.Table.from_batches(held)
                yield forest(whole.slice(0, chunk))
                made, held = made + 1, whole.slice(chunk).to_batches()
        if sum(b.num_rows for b in held):
            yield forest(pa.Table.from_batches(held))
        give_back()

    return rows.mapInArrow(run, "chunk long, body binary")


def first_rows(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_chunks: int, k: int, same_label: bool, group: int = GROUP, leaf: int = LEAF) -> DataFrame:
    """anchor_id, window, rank (from 1), id, score: the first k candidates of each anchor in each of its windows. anchors:
    vec_id, label, v, low, high (arrays of one length for all); candidates: a written table of chunks()."""
    spark = candidates.sparkSession
    groups = -(-n_anchors // group)
    parts = max(1, min(n_chunks, -(-2 * spark.sparkContext.defaultParallelism // groups)))

    def planted(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        forest = Forest.build(part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(list(part["v"])), leaf)
        windows = [np.array(part[c].tolist(), np.int64)[forest.order] for c in ("low", "high")]
        out = io.BytesIO()
        np.savez(out, low=windows[0], high=windows[1])
        return pd.DataFrame({"g": [key[0]], "kind": [0], "chunk": [0], "body": [forest.packed()], "windows": [out.getvalue()]})

    number = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("g")
    trees = anchors.withColumn("g", number).groupBy("g").applyInPandas(planted, "g long, kind int, chunk long, body binary, windows binary")
    trees = trees.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = candidates.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"), F.lit(1).alias("kind"), "chunk", "body", F.lit(None).cast("binary").alias("windows"), F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int").alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for i in range(batch.num_rows):
                body = Forest.unpacked(batch.column("body")[i].as_buffer())
                if batch.column("kind")[i].as_py() == 0:
                    if best:
                        yield told(best)
                    with np.load(io.BytesIO(batch.column("windows")[i].as_buffer())) as w:
                        best = Best(body, w["low"], w["high"], k)
                elif best:
                    search(best, body, same_label)
        if best:
            yield told(best)
        give_back()

    def told(best: Best) -> pa.RecordBatch:
        row, window, rank = np.nonzero(best.score > _LEAST)
        return pa.RecordBatch.from_arrays([pa.array(best.forest.ids[row]), pa.array(window.astype(np.int32)), pa.array(best.id[row, window, rank]), pa.array(best.score[row, window, rank])], names=["anchor_id", "window", "id", "score"])

    together = trees.unionByName(met).repartitionById(groups * parts, (F.col("g") * parts + F.col("s")).cast("int")).sortWithinPartitions("g", "s", "kind", "chunk")
    found = together.select("kind", "body", "windows").mapInArrow(run, "anchor_id long, window int, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id"))  # parts * k rows at most
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("anchor_id", "window", "rank", "id", "score")


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label", anchors: str = "vec_id % 100 = 0",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256, chunk: int = CHUNK, group: int = GROUP, leaf: int = LEAF,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. anchors: a condition on vec_id and label.
    least, most: a negative's score in hundredths of the positive's."""
    spark = rows.sparkSession
    vectors = written(usable(rows, id_col, vector_col, label_col, scale), "vectors")
    candidates = written(chunks(vectors, max(negatives, positives + 1), chunk, leaf), "chunks")
    wanted = vectors.where(anchors)
    n_anchors, n_chunks = wanted.count(), candidates.count()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], schema)
    window = lambda low, high: {"low": F.array(F.lit(low)), "high": F.array(F.lit(high))}
    found = written(first_rows(wanted.withColumns(window(_LEAST + 1, _MOST - 1)), candidates, n_anchors, n_chunks, positives, True, group, leaf), "positives")
    # a window that nothing meets stands for a positive that is not there
    best = found.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("rank", "score"))).alias("scores"))  # `positives` of them at most
    hundredth = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")  # noqa: E731  rounded down
    each = range(1, positives + 1)
    low = F.array(*[F.coalesce(-hundredth(f"({-least} * scores[{r}])"), F.lit(_MOST - 1)) for r in each])
    high = F.array(*[F.coalesce(hundredth(f"({most} * scores[{r}])"), F.lit(_LEAST + 1)) for r in each])
    windows = wanted.join(best.select(F.col("anchor_id").alias("vec_id"), low.alias("low"), high.alias("high")), "vec_id")
    lower = first_rows(windows, candidates, n_anchors, n_chunks, negatives, False, group, leaf)
    pairs = found.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = lower.join(pairs, ["anchor_id", "window"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
