"""Helpers that the operators of this subpackage share: shared storage, word rules and byte hashing."""

from __future__ import annotations

import ctypes
import hashlib
import itertools
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these bytes: space and tab to carriage return.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side of a join is broadcast by hand only after its rows were counted and are no more than this.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under the folder that the cluster shares (spark.checkpoint.dir).

    Only a local session may leave it unset, as in tests; on a cluster a folder of one machine would lose rows.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="opinara-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read back: lineage ends there and survives lost executors."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


def spent(*tables: DataFrame) -> None:
    """Delete tables made by ``cut`` that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._table)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` (already cut, so that counting is cheap) has at most ``limit`` rows."""
    return df.limit(limit + 1).count() <= limit


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows allow it; else as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, limit) else df


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of few rows, so that long texts do not all become Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return what a worker has freed to the machine, as an idle worker stays beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- byte hashing of words with numpy -------------------------------------------------------

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Words of more bytes than this are hashed one by one. Each (place, byte) of a shorter one has a random number of its own,
#: so no pattern of letters cancels out, as powers of one base modulo 2**64 let it.
_SHORT = 64
_NUMBERS = mix(mix(np.arange(1, _SHORT * 256 + 1, dtype=np.uint64)) + np.uint64(0x9E3779B97F4A7C15))


def words_of_texts(texts: Sequence[str | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of the words of whole texts, in order and end to end, and where each text's begin (and all end).

    A-Z are lower-cased first if ``fold``; a null or blank text has no words.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = b"\n".join(parts)
    if fold:
        raw = raw.translate(_FOLD)
    b = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[b]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.searchsorted(start, np.cumsum([0, *(len(x) + 1 for x in parts)]))
    if not len(start):
        return np.empty(0, np.uint64), bounds
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1])
    place -= np.repeat(first, size)
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        np.minimum(place, _SHORT - 1, out=place)
    place <<= 8
    place |= b[inside[1:-1].view(bool)]
    h = mix(np.bitwise_xor.reduceat(_NUMBERS.take(place), first))
    for i in long:
        h[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest(), "little")
    return h, bounds


def word_hashes(text: str | None, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word of the whole text, in order."""
    return words_of_texts([text], fold)[0]


def _runs(w: np.ndarray, width: int) -> np.ndarray:
    h = np.full(max(0, len(w) - width + 1), width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = mix(h * np.uint64(0xA0761D6478BD642F) + w[i : i + len(h)])
    return h


def shingle_sets(texts: Sequence[str | None], width: int) -> list[np.ndarray]:
    """For each text its set: sorted distinct 64-bit hashes of the runs of ``width`` words; a shorter text is one run; none
    without words."""
    w, bounds = words_of_texts(texts)
    h, out = _runs(w, width), []
    for low, high in itertools.pairwise(bounds.tolist()):
        own = h[low : high - width + 1] if high - low >= width else _runs(w[low:high], high - low) if high > low else w[:0]
        own = np.sort(own)
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """The set of one text; see ``shingle_sets``."""
    return shingle_sets([text], width)[0]
