"""Shared pieces of the corpus operators: tables, session settings, checkpoints and byte-level text helpers.

Texts reach Python as Arrow batches.  The helpers below look at the UTF-8 buffer of a batch directly, in
slices of a few MB, so that temporary arrays stay small however long a batch is.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shared import small_batches as small_batches

SLICE_BYTES = 2 << 20
ODD_BASE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where that is unset, a temporary one if Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        used = spark.sparkContext._jsc.sc().getCheckpointDir()
        if used.isDefined():
            return used.get()
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)  # the setting itself can't be changed in a session
    return folder


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet to the shared folder: for tables that are read several times, by few columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def utf8_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, row after the last, bytes, offsets into them); null rows have no bytes.

    A slice holds at most ``most`` bytes unless one row alone is longer."""
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def byte_table(chars: bytes = b"", above_ascii: bool = False, *, inverse: bool = False) -> np.ndarray:
    """A lookup of 256 booleans: the bytes given, and those of non-ASCII characters if asked for."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    out[128:] = above_ascii
    return ~out if inverse else out


#: Words are maximal runs of other characters than these (space and the controls 09 to 0D).
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_BLANK = byte_table(BLANK, inverse=True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that do not cross the row bounds in ``offsets``."""
    n = len(mask)
    before, after = np.empty(n + 1, bool), np.empty(n + 1, bool)
    before[0], before[1:] = False, mask
    after[:n], after[n] = mask, False
    before[offsets], after[offsets] = False, False
    return np.flatnonzero(mask & ~before[:n]), np.flatnonzero(mask & ~after[1:]) + 1


def _powers(base: int) -> np.ndarray:
    out = np.full(1 << 16, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse; grown when a longer slice comes."""

    def __init__(self, base: int = int(ODD_BASE)) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = _powers(self.base), _powers(self.inverse)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                out = np.full(size, np.uint64(base), np.uint64)
                out[0] = 1
                setattr(self, name, np.multiply.accumulate(out))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = sum of values[i] * base**i for s <= i < e, modulo 2**64."""
    up, _ = POWERS.upto(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit hashes of the spans, depending on their contents alone."""
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1)), starts, ends)
