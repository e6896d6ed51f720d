"""Periodic runs of words, found online by catchers of squares over dyadic blocks.

Words arrive by ``Catchers.append``, as many at a time as the caller likes. For each power of two B, every completed block
of B words at a multiple of B has a catcher of the squares whose period is 2B to 4B - 1 (period 1 has a chain of its own):
the catcher compares its block with each window of B words that ends at an appended word at such a distance. If w[i] equals
w[i + q] for 3q words on end, as in any stretch of four periods, at least five blocks on end meet their copies at distance
q; so after the fifth the stretch is compared word by word, to the left as far as it goes and to the right as words arrive.
From its 2q-th word on each further word completes a square; squares of one period that follow one another are one run.

Windows are compared by hashes built from those of half their length, so that all catchers of a level advance by a few numpy
operations for each appended part; hashes only choose what is compared, words decide. A stretch inside a run whose period
divides its own is that run again and is left out before it is compared. State: the words, and for each level some 5B hashes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, mix, slices

#: A run holds its period this often at least, and this many words.
TIMES, LEAST = 4, 6
#: Blocks on end that must meet their copies before words are compared: a stretch of 3 periods of 2B words or more has five.
CHAIN = 5
#: Words that are gathered from documents before they are appended.
PART = 1 << 16
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


class Buffer:
    """A numpy array that grows at its end."""

    def __init__(self, dtype: type, fill: int = 0):
        self.held, self.n, self.fill = np.full(1024, fill, dtype), 0, fill

    def extend(self, k: int) -> None:
        if self.n + k > len(self.held):
            more = np.full(max(2 * len(self.held), self.n + k), self.fill, self.held.dtype)
            more[: self.n] = self.held[: self.n]
            self.held = more
        self.n += k


def _alike(w: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from ``i`` on equal those from ``j`` > ``i`` on, before ``end``; parts double, so little is read in vain."""
    n, step = 0, 32
    while j + n < end:
        k = min(step, end - j - n)
        differ = w[i + n : i + n + k] != w[j + n : j + n + k]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + k, 2 * step
    return n


def _alike_before(w: np.ndarray, i: int, j: int) -> int:
    """How many words before ``i`` equal those before ``j`` > ``i``."""
    n, step = 0, 32
    while n < i:
        k = min(step, i - n)
        differ = (w[i - n - k : i - n] != w[j - n - k : j - n])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + k, 2 * step
    return n


class Level:
    """The catchers of all blocks of one size: hashes of windows of ``size`` words, from window ``base`` on to ``n``, and
    for each window whether it met the nearer and the farther of its two blocks, from the place ``n - len(met)`` on."""

    def __init__(self, size: int):
        self.size, self.base, self.n = size, 0, 0
        self.hashes = np.empty(0, np.uint64)
        self.met = [np.zeros(CHAIN * size, bool) for _ in range(2)]

    def take(self, more: np.ndarray) -> None:
        self.hashes, self.n = np.concatenate([self.hashes, more]), self.n + len(more)

    def caught(self, since: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, distance) where a chain of ``CHAIN`` blocks, not ``CHAIN + 1``, has met its copies at a window from
        ``since`` on."""
        size, old = self.size, CHAIN * self.size
        at = np.arange(since, self.n)
        near = (at - 2 * size) // size * size  # the nearer block lies 2B to 3B - 1 words before, the farther B more
        found, far = [], []
        for k, block in enumerate((near, near - size)):
            good = block >= max(0, self.base)
            met = np.zeros(len(at), bool)
            met[good] = self.hashes[at[good] - self.base] == self.hashes[block[good] - self.base]
            self.met[k] = seen = np.concatenate([self.met[k][-old:], met])
            if met.any():
                chain = seen[old:].copy()
                for step in range(1, CHAIN):
                    chain &= seen[old - step * size : len(seen) - step * size]
                chain &= ~seen[: len(seen) - old]
                i = np.flatnonzero(chain)
                found.append(at[i])
                far.append(at[i] - block[i])
        if not found:
            return at[:0], at[:0]
        return np.concatenate(found), np.concatenate(far)

    def forget(self) -> None:
        """Drop hashes that no later window or larger level asks for."""
        if len(self.hashes) > 16 * self.size + PART:
            keep = 6 * self.size
            self.hashes, self.base = self.hashes[-keep:].copy(), self.n - keep


class Catchers:
    """``append`` word numbers (equal words have equal ones; a number below zero equals nothing, so it ends all runs);
    ``runs()`` are those of all words so far, as rows (start, end, period) by start, then period."""

    def __init__(self):
        self.words, self.reach, self.period = Buffer(np.int64), Buffer(np.int64), Buffer(np.int64, 1)
        self.levels = [Level(1)]
        self.chained = 0  # words that the chain of period 1 has seen
        self.open: list[list[int]] = []  # stretches [start, end, period] that go on to the last word
        self.found: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        was = self.words.n
        for buffer in (self.words, self.reach, self.period):
            buffer.extend(len(words))
        n = self.words.n
        self.words.held[was:n] = words
        # each open stretch takes the appended words as long as they equal those one period before
        going, self.open = self.open, []
        for start, end, q in sorted(going, key=lambda x: x[2]):
            self._advance(start, end, q)
        self._period_one(n)
        k = 0
        while k < len(self.levels):
            level = self.levels[k]
            since = level.n
            level.take(self._hashes(k, n))
            if level.n > since:
                at, q = level.caught(since)
                if len(at):
                    self._stretches(level.size, at, q)
            if k + 1 == len(self.levels) and n >= 2 * level.size:
                self.levels.append(Level(2 * level.size))
            k += 1
        for level in self.levels:
            level.forget()

    def _hashes(self, k: int, n: int) -> np.ndarray:
        """Hashes of the level's further windows, from those of half the length."""
        level = self.levels[k]
        if k == 0:
            with np.errstate(over="ignore"):
                return self.words.held[level.n : n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        half = self.levels[k - 1]
        low, count = level.n - half.base, max(0, n - level.size + 1 - level.n)
        h = half.hashes[low : low + count + half.size]
        with np.errstate(over="ignore"):
            return h[:count] * _ODD[k % 64] + h[half.size : half.size + count]

    def _period_one(self, n: int) -> None:
        w, low = self.words.held, max(0, self.chained - LEAST)
        if n < 2:
            return
        same = np.concatenate([[False], w[low : n - 1] == w[low + 1 : n], [False]])
        same[1:-1] &= w[low : n - 1] >= 0
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            start, end = low + a, low + b + 1
            if end - start >= LEAST and end > self.chained and not (end == n and any(q == 1 for _, _, q in self.open)):
                self._advance(start - _alike_before(w, start, start + 1), end, 1)
        self.chained = n

    def _stretches(self, size: int, at: np.ndarray, q: np.ndarray) -> None:
        """Compare the words of chains, but those inside a run whose period divides their distance."""
        first = at - (CHAIN - 1) * size - q
        again = (self.reach.held[first] >= at + size) & (q % self.period.held[first] == 0)
        w, n = self.words.held, self.words.n
        for i, d in zip(at[~again].tolist(), q[~again].tolist()):
            low = i - (CHAIN - 1) * size
            if self.reach.held[low - d] >= i + size and d % int(self.period.held[low - d]) == 0:
                continue
            got = _alike(w, low - d, low, n)
            if got >= CHAIN * size:  # else the hashes were alike and the words were not
                start = low - d - _alike_before(w, low - d, low)
                self._advance(start, low + got, d)

    def _advance(self, start: int, end: int, q: int) -> None:
        """A stretch of period ``q`` from ``start`` to ``end`` takes further words; a run if it is long enough."""
        w, n = self.words.held, self.words.n
        end += _alike(w, end - q, end, n)
        if end == n:
            self.open.append([start, end, q])
        if end - start >= max(LEAST, TIMES * q):
            reach, period = self.reach.held[start:end], self.period.held[start:end]
            new = reach < end
            period[new], reach[new] = q, end
            if end < n and q <= self.found.get((start, end), q):
                self.found[start, end] = q

    def runs(self) -> np.ndarray:
        """A stretch found at a multiple of a run's period is that run."""
        found = dict(self.found)
        for start, end, q in self.open:
            if end - start >= max(LEAST, TIMES * q) and q <= found.get((start, end), q):
                found[start, end] = q
        return np.array(sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray) -> np.ndarray:
    """The runs of one sequence of word numbers, appended in parts."""
    catchers = Catchers()
    for at in range(0, len(words), PART):
        catchers.append(words[at : at + PART])
    return catchers.runs()


RUNS = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
SUMMARY = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _documents(texts: list[str | None]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """For each text its place in the list, its words and its runs; texts are appended one after another, a number that
    equals nothing between them."""
    held, numbers, flat, size = [], {}, [], 0

    def close() -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        runs = runs_of(np.concatenate(flat)) if flat else np.empty((0, 3), np.int64)
        at = 0
        for k, words in held:
            low, high = np.searchsorted(runs[:, 0], [at, at + len(words)])
            yield k, words, runs[low:high] - np.array([at, at, 0])
            at += len(words) + 1

    for k, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: at space and tab to carriage return
        number = numbers.setdefault
        flat.append(np.fromiter((number(x, len(numbers)) for x in words), np.int64, len(words)))
        flat.append(np.array([-1 - k], np.int64))
        held.append((k, words))
        size += len(words) + 1
        if size >= PART:
            yield from close()
            held, numbers, flat, size = [], {}, [], 0
    yield from close()


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, end, q in runs.tolist():
        keep[start + q : end] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def greatest(runs: np.ndarray) -> tuple[int, int, int, int] | tuple[None, None, None, None]:
    """Start, length, period and thousandths of length by period of the run with most periods; ties: least start, period."""

    def more(a: list[int], b: list[int]) -> int:
        return (b[1] - b[0]) * a[2] - (a[1] - a[0]) * b[2] or a[0] - b[0] or a[2] - b[2]

    if not len(runs):
        return None, None, None, None
    start, end, q = min(runs.tolist(), key=functools.cmp_to_key(more))
    return start, end - start, q, 1000 * (end - start) // q


def _each(docs: DataFrame, schema: str, of) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [of(words, runs) for _, words, runs in _documents(part.column("text").to_pylist())]
            table = pa.Table.from_pylist(rows, schema=types) if rows else None
            if table is not None:
                yield table.append_column("doc_id", part.column("doc_id")).select(["doc_id", *types.names]).combine_chunks().to_batches()[0]
        give_back()

    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    arrow = {"long": pa.int64(), "string": pa.string()}
    types = pa.schema([(name, arrow.get(kind, struct)) for name, kind in (x.split(" ", 1) for x in schema.split(", ")[1:])])
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, schema)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_words, runs`` by start, then period, and the ``collapsed`` text.

    A run is a stretch of words with smallest period q, at least 4q and 6 words long, that no neighbouring word extends. A
    null or empty text has no words and no runs; very long texts are read whole; a null doc_id stays; repeated rows give a row
    each; an empty table gives none; other columns, whatever their names, are ignored. Nothing is shuffled.
    """

    def of(words: list[bytes], runs: np.ndarray) -> dict:
        said = [{"start": s, "length": e - s, "period": q} for s, e, q in runs.tolist()]
        return {"n_words": len(words), "runs": said, "collapsed": collapse(words, runs).decode("utf-8", "replace")}

    return _each(docs, RUNS, of)


def run_digests(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_runs``, the run with most periods (nulls if there is none) and SHA-256 of all
    runs (``start,length,period`` and a line end each) and of the collapsed text; rows as in ``periodic_runs``."""

    def of(words: list[bytes], runs: np.ndarray) -> dict:
        start, length, q, milli = greatest(runs)
        said = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs.tolist())
        return {
            "n_runs": len(runs), "start": start, "length": length, "period": q, "exponent_milli": milli,
            "runs_sha256": hashlib.sha256(said.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(collapse(words, runs)).hexdigest(),
        }

    return _each(docs, SUMMARY, of)


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a period planted where 10 divides h, the CRC-32 of the decimal doc_id: with g = h / 10, n words,
    a = g % n and p = 1 + (n - a) / (3 + g % 8), each word i >= a becomes word a + (i - a) % p. Others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.col("text").cast("string")

    def planted(w: Column, g: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        return F.array_join(F.concat(F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), 1, n - a)), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    some = (h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    once = F.transform(F.array(words), lambda w: planted(w, F.floor(h / 10)))[0]  # a lambda's variable is computed once
    return docs.select("doc_id", F.when(some, once).otherwise(text).alias("text"))
