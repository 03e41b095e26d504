"""Helpers that several operators share: Arrow text slices, word tables, hashes.

Words are maximal runs of characters other than space, tab, line feed, vertical
tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``).  All six are single
bytes in UTF-8, so words are found on the bytes of a whole Arrow slice at once.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0  # white space adds nothing to a word's sum
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base = base & (2**64 - 1)
        self.inverse = pow(self.base, -1, 2**64)
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    @staticmethod
    def _grow(have: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(have) < n:
            step = np.uint64(pow(base, len(have), 2**64))
            have = np.concatenate([have, have * step])
        return have

    def up(self, n: int) -> np.ndarray:
        self._up = self._grow(self._up, self.base, n)
        return self._up[:n]

    def down(self, n: int) -> np.ndarray:
        self._down = self._grow(self._down, self.inverse, n)
        return self._down[:n]


_IN_WORD = Powers(int(_BASE))
_OVER_WORDS = Powers(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) over unsigned values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose text takes about ``limit`` bytes (one row at least)."""
    text = batch.column(column)
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) else np.int64)
    offsets = offsets[text.offset : text.offset + len(text) + 1]
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and len+1 offsets into them; null counts as empty."""
    if text.null_count:
        text = text.fill_null("")
    kind = np.int32 if pa.types.is_string(text.type) else np.int64
    offsets = np.frombuffer(text.buffers()[1], kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    if text.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_table(text: pa.Array, lower: bool = False, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, start, end) of every word of the texts; start and end count bytes
    over the joined texts.  ``lower`` folds A-Z before hashing; ``space`` marks the bytes
    between words (white space among them)."""
    data, offsets = text_bytes(text)
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    inside = ~space[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | first[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    row = np.searchsorted(offsets, start, "right") - 1
    if lower:
        data = _LOWER[data]
    at = np.arange(start[0], n) - np.repeat(start, np.diff(np.append(start, n)))
    # bytes between words have weight zero, so a word's sum ends where the word does
    weights = _IN_WORD.up(int(at.max()) + 1)
    value = _BYTE if space is _SPACE else np.where(space, np.uint64(0), _BYTE)
    sums = np.add.reduceat(value[data[start[0] :]] * weights[at], start - start[0])
    return row, mix(sums + (end - start).astype(np.uint64)), start, end


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries (over document borders too)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _OVER_WORDS.up(len(words)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _OVER_WORDS.down(n))


def tag_hash(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """One hash of two 64-bit values."""
    return mix(a ^ (mix(np.asarray(b).astype(np.uint64)) + np.uint64(0x51_7C_C1_B7_27_22_0A_95)))


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as the longs that Spark knows."""
    return pa.array(x.view(np.int64))


def span_hash(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of words[start:end] for each pair of bounds."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _OVER_WORDS.up(len(words)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _OVER_WORDS.down(len(words) + 1)[start] + (end - start).astype(np.uint64))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset, a single-machine session (``local[n]``, as in tests) gets a
    folder of its own; any other session is refused, as its executors could not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """The rows of ``df`` written as Parquet in the shared folder, and read again:
    cuts the lineage, and lets later steps read them without computing them twice."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_folder = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes the folder of rows that ``written`` returned; nothing may read them any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._llm_folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def release(spark: SparkSession) -> None:
    """Asks Python and the JVM to collect garbage: Spark then drops the shuffle files of
    plans that are done, which a long job of several written steps would else pile up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list:
    """Columns that identify a row also where ids are null or repeat: rows equal in
    both hold the same text, so what is found for one holds for the other."""
    return [F.coalesce(F.col(doc_id), F.lit(-(2**63))).alias("_llm_id"), F.xxhash64(F.col(text)).alias("_llm_th")]
