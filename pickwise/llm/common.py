"""Shared helpers of the training-data operators.

Texts reach Python as Arrow batches; the helpers below work on the UTF-8 bytes
of many texts at once, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.session import shared_dir

SLICE_BYTES = 1 << 20  # text bytes handled at once inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def persisted(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage is
    cut and a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Shipped:
    """A large model for the tasks.  Its plain data (arrays, lists) is broadcast and its
    class travels with the function that uses it, so executors need no installed copy."""

    def __init__(self, spark: SparkSession, model: object):
        self.kind, self.data, self.made = type(model), spark.sparkContext.broadcast(vars(model)), None

    def __getstate__(self) -> dict:
        return {"kind": self.kind, "data": self.data, "made": None}

    @property
    def value(self):
        if self.made is None:
            self.made = object.__new__(self.kind)
            self.made.__dict__.update(self.data.value)
        return self.made

    def drop(self) -> None:
        """Frees the model in this task; the next use reads it again."""
        self.made = None
        vars(self.data).pop("_value", None)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def octets(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as large binary, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large binary array, and the offset of each value."""
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(off) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of the batches with at most ``most`` text bytes in all,
    or one row whose text alone is longer."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(size[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def is_space(b: np.ndarray) -> np.ndarray:
    """ASCII white space: 0x09 to 0x0D and 0x20."""
    return (b == 32) | ((b >= 9) & (b <= 13))


_powers: dict[str, np.ndarray] = {}
# An odd multiplier, its inverse modulo 2^64, and the constants of
# the public splitmix64 finaliser.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULTIPLIER^i and INVERSE^i for i below n, modulo 2^64 (kept up to one slice)."""
    if "up" in _powers and len(_powers["up"]) >= n:
        return _powers["up"][:n], _powers["down"][:n]
    made = []
    for base in (MULTIPLIER, INVERSE):
        p = np.full(max(n, SLICE_BYTES), np.uint64(base), np.uint64)
        p[0] = 1
        made.append(np.cumprod(p))
    if n <= 2 * SLICE_BYTES:
        _powers["up"], _powers["down"] = made
    return made[0][:n], made[1][:n]


class Prefix:
    """Prefix sums that give the 64-bit hash of any byte range in O(1)."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def lowered(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z and the Latin-1 capitals (UTF-8 C3 80 to C3 9E) in lower case."""
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    if len(out) > 1:
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
        out[after] += 32
    return out


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the True runs of ``mask``; no run crosses an offset."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(mask) + 1, bool)
    edge[off] = True
    before = np.concatenate(([False], mask[:-1]))
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    after = np.concatenate((mask[1:], [False]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs of ASCII letters and digits and of non-ASCII bytes."""
    return runs(_WORD[data], off)
