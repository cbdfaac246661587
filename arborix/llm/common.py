"""Shared plumbing: shared scratch tables, Arrow batch helpers, vectorised word hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.package import ship

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only where none is set and all tasks run on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="arborix-")
        spark.sparkContext.setCheckpointDir(where)
    return where


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.frames: list[DataFrame] = []
        lean(spark)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.frames.append(out)
        return out

    def save_by(self, df: DataFrame, column: str) -> DataFrame:
        """The table in buckets of a column's hash, as many as shuffles have partitions, so that joins on the column don't shuffle it."""
        self.n += 1
        path, name = f"{self.base}/{self.n}", f"arborix_{uuid.uuid4().hex}"
        df.write.bucketBy(n_parts(self.spark), column).option("path", path).saveAsTable(name)
        out = self.spark.table(name)
        out._scratch_path, out._scratch_table = path, name
        self.frames.append(out)
        return out

    def keep(self, *frames: DataFrame) -> None:
        """Drop all tables but these; nothing that reads the others may run later."""
        self.drop(*(x for x in self.frames if not any(x is y for y in frames)))

    def delete(self, where: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if table := getattr(df, "_scratch_table", None):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.delete(df._scratch_path)
        self.frames = [x for x in self.frames if not any(x is y for y in frames)]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    lean(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_bucket(column: str, modulus: int):
    """crc32 of the column as text, modulo."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def lean(spark: SparkSession) -> None:
    """Ship the package, and bound the Arrow batches that executors hold beside the heap, where the user has left Spark's defaults."""
    ship(spark)
    for key, default, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, own)


def trim() -> None:
    """Give freed memory back, as a worker waits for its next task beside the executor's other ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: What a worker remembers between tasks of one operator, by name, with what makes it forget.
_HELD: dict = {}


def hold(name: str, clear) -> None:
    """Forget what is remembered under the name once a worker gets a task that doesn't keep it."""
    _HELD[name] = clear


def portions(batches, rows: int = 512, keep: str = ""):
    """Batches of at most so many rows, so that few texts are held as Python objects at once."""
    for name in [x for x in _HELD if x != keep]:
        _HELD.pop(name)()
        trim()
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
    trim()


def slices(batch: pa.RecordBatch, lengths: np.ndarray, most: int):
    """Row ranges of a batch whose lengths sum to about most; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    have = 1
    while have <= n:
        step = np.uint64(pow(base, have, 1 << 64))
        take = min(have, n + 1 - have)
        out[have : have + take] = out[:take] * step
        have += take
    return out


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words of the texts, in order, and the first word's place of each text (one more at the end).

    A word is a run of ASCII letters, digits and non-ASCII characters."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    word = _WORD[joined]
    edge = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up = np.concatenate((np.zeros(1, np.uint64), np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(joined))[:-1], dtype=np.uint64)))
    down = powers(_BASE_INV, len(joined))
    with np.errstate(over="ignore"):
        hashes = mix((up[end] - up[start]) * down[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    return hashes, np.concatenate(([0], np.searchsorted(start, ends)))
