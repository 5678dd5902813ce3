"""What the operators of this subpackage share: column picking, shared storage, text slabs."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import hashlib
import itertools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that `[\x20\x09-\x0D]` names.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_own_dir: str | None = None
#: The folder of this process's tables: other jobs that share the cluster's folder have their own.
_RUN = f"sigweave/{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str) -> int:
    """Position of a column by exact name, else by name in any case."""
    found = [i for i, c in enumerate(df.columns) if c == name]
    found = found or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found[0]


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns (new name = old name). Other columns may have any names, clashing ones too."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{column(df, old)}").alias(new) for new, old in wanted.items()])


def text_of(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. A folder of our own serves only
    where that is unset and the session is local."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="sigweave-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder. It cuts lineage, survives the loss of executors, and lets a join
    that reads it shuffle it afresh, so that adaptive execution may split hot keys."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_RUN}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes this process's tables of written(); call it when results that read them have been stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{_RUN}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sent_file(spark: SparkSession, tag: str, write: Callable[[str], None]) -> str:
    """Sends what write(path) makes to all executors, those to come too: a name for SparkFiles.get, which tells the content."""
    folder = tempfile.mkdtemp(prefix="sigweave-")  # the driver's own: executors fetch the file from the driver
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    write(made := os.path.join(folder, "made"))
    with open(made, "rb") as file:
        name = f"{tag}-{hashlib.file_digest(file, 'sha256').hexdigest()[:24]}.bin"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        shutil.rmtree(folder, ignore_errors=True)
    else:
        os.rename(made, path := os.path.join(folder, name))
        spark.sparkContext.addFile(path)
    return name


class Slab:
    """Adjacent rows of an Arrow batch: their texts as one byte array with row bounds."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray):
        self.rows, self.data, self.bounds = rows, data, bounds

    def __len__(self) -> int:
        return self.rows.num_rows


def give_back() -> None:
    """Returns freed memory of a worker that goes on to live to the system: Arrow's pool, then the C library's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slabs(batches: Iterator[pa.RecordBatch], text: str, limit: int = 512 << 10) -> Iterator[Slab]:
    """Batches in slabs of about `limit` bytes of text; a longer single text is a slab of its own."""
    yield from _slabs(batches, text, limit)
    give_back()


def _slabs(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[Slab]:
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            to = min(to, len(col))
            yield Slab(batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a slab. starts, ends: into the data; first: of each row among the
    words, with one more entry at the end."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        solid = ~SPACES[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[bounds] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = solid[:-1]
        before[edge[:-1]] = False
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = solid[1:]
        after[edge[1:]] = False
        self.solid = solid
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def joined(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of each row with one space between them, rows adjacent: bytes, word starts, word ends."""
        if not len(self.starts):
            return np.zeros(0, np.uint8), self.starts, self.ends
        head = np.zeros(len(self.starts) + 1, dtype=bool)
        head[self.first] = True
        keep = self.solid.copy()
        gap = self.starts[~head[:-1]] - 1
        keep[gap] = True
        out = data[keep]
        size = self.ends - self.starts
        starts = np.cumsum(size + ~head[:-1]) - size
        out[starts[~head[:-1]] - 1] = 0x20
        return out, starts, starts + size


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batched(rows: Iterator[dict], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)
