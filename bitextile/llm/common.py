"""What the operators of this subpackage share: written results, and hashing of Arrow batches of texts.

Hashes are polynomials modulo 2**64 over a fixed random table of the 256 byte values. Prefix sums of one buffer give
the hash of any slice of it in constant time, so words, word n-grams and byte windows of a whole batch of texts are
hashed without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import folder

CHUNK = 1_000_000  # bytes of text that are hashed at once; one longer text is a chunk by itself
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
TABLE = np.random.default_rng(20_240_501).integers(1, 1 << 64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage and outlives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of fewer rows for what runs within, where a row may hold a whole set or text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def key_of(*values: Column) -> Column:
    """16 bytes for each different row of values: two hashes of different seeds."""
    return F.unhex(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), *values)), 16, "0") for seed in (1, 2))))


def texts_of(df: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and text, null read as the empty text."""
    return df.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, made from `name`."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


@dataclass
class Chunk:
    """Some whole texts of a batch: rows [first, last) of it, their bytes and their offsets into these."""

    batch: pa.RecordBatch
    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name)).slice(self.first, self.last - self.first)

    @property
    def n(self) -> int:
        return self.last - self.first


def chunks(batches: Iterator[pa.RecordBatch], name: str = "text", size: int = CHUNK) -> Iterator[Chunk]:
    """Cut Arrow batches into runs of whole texts with about `size` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(name))
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        _, offs, buf = col.buffers()
        offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(col):
            last = max(first + 1, int(np.searchsorted(offs, offs[first] + size, "right")) - 1)
            last = min(last, len(col))
            yield Chunk(batch, first, last, data[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
            first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i modulo 2**64 for i < n."""
    have = _powers.get(0)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for k, base in ((0, BASE), (1, INVERSE)):
            p = np.full(size, base & ((1 << 64) - 1), np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers[k] = p
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slices:
    """Hashes of slices of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        p, self.inverse = powers(len(values) + 1)
        self.sums = np.empty(len(values) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(values * p[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


@dataclass
class Words:
    """The words of a chunk: hashes, byte bounds, and for each text the number of its first word (n + 1 values)."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of n words inside one text, and the number of its first word."""
        if len(self.hashes) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(len(self.hashes) - n + 1)
        last = self.first[1:][np.searchsorted(self.first[1:], at, "right")]
        at = at[at + n <= last]
        return Slices(self.hashes).hash(at, at + n), at

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """The row in the chunk of each word number."""
        return np.searchsorted(self.first, at, "right") - 1


def byte_class(members: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = ~byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
ALPHANUMERIC = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyz") | byte_class(range(128, 256))


def words(chunk: Chunk, member: np.ndarray) -> Words:
    """Words are maximal runs of bytes of the class `member`, A-Z read as a-z; they never cross texts."""
    data = LOWER[chunk.data]
    inside = member[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    h = Slices(TABLE[data]).hash(start, end)
    return Words(h, start, end, np.searchsorted(start, chunk.offsets))


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours: len(x) - w + 1 values."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])
    return out


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values in a row and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
