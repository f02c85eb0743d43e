"""Shared helpers: column hygiene, Arrow batches in bounded slices, word hashing.

Text helpers work on the UTF-8 bytes of a whole Arrow batch at once, so the
cost per document is a few numpy steps shared by all documents of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"          # fixed by the contracts
SLICE_BYTES = 2 << 20                # text bytes handled at once; a longer text is a slice of its own

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column (in any case) has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under fixed names."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))


def in_fold(doc_id: Column, mod: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``mod`` equals ``remainder`` (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let a Python worker get at most ``rows`` rows at once, unless the session asks for fewer.

    The default of 10,000 rows would be a gigabyte of long texts in the
    worker and again in its executor.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices holding at most ``most`` bytes of text each, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size, dtype=np.int64), 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, offsets of the texts); a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = pa.concat_arrays([column]) if column.offset == 0 else pa.array(column.to_pylist(), pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte of every word, and the index of each text's first word (one more at the end)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    gap = np.ones(n + 1, bool)
    np.take(space, data, out=gap[:n])
    word = ~gap[:n]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.ones(n, bool)
    before[1:] = gap[:n - 1] | cut[1:n]
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & (gap[1:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; the bytes of other letters never fall in that range."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), in place on a copy."""
    x = x.copy()
    for s, m in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(s)
        x *= np.uint64(m)
    x ^= x >> np.uint64(33)
    return x


class _Poly:
    """Polynomial hashes of any span of a sequence, from one running sum modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            steps = np.ones((2, n), np.uint64)
            steps[0, 1:], steps[1, 1:] = self.base, self.inverse
            self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.up, self.down

    def sums(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], dtype=np.uint64, out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self.powers(len(sums))
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, 256).astype(np.uint64)
BYTES, WORDS = _Poly(0x9E3779B97F4A7C17 | 3), _Poly(0xD1342543DE82EF97 | 3)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; the same on every machine and in every run."""
    return BYTES.spans(BYTES.sums(_BYTE[data]), starts, ends)


def ragged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The positions start..end-1 of all spans, one span after another."""
    size = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)


def worker_cache() -> dict:
    """What a Python worker keeps between tasks, even where this package is shipped by value."""
    import pyspark
    return pyspark.__dict__.setdefault("_panelflow_kept", {})

