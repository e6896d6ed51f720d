"""N-gram Jaccard join: components of documents whose shingle sets are similar, by T-occurrence search with DivideSkip.

1. One inverted index over all documents, partitioned by element. A list's length is in how many sets its element occurs.
   Lists are ordered by length, so every set knows which of its lists are short and which are long.
2. A set of n elements links only with sets that hold T = ceil(limit * n) of them. With the T - 1 longest lists put aside,
   such a set is still found in one of the n - T + 1 short ones. Each set is therefore entered in its short lists only, and
   sets that meet in one are candidates. Lists of one set are never moved, and long ones (passages that many documents
   share) only where a set consists of little else. Candidates form families; a family is closed under links.
3. Within a family, or a bounded pair of blocks of a large one, each set is a query: the L longest lists are put aside, the
   others are merged, sets found T - L times are kept, and the long lists are probed for them by binary search. Sets that
   reach the overlap link. Short lists are merged by counting places in one array, which gives the counts that a heap of
   list heads gives.
4. A large family is first measured against a few of its sets, the hubs. What hangs together by them needs no further
   pairs: only the sets outside the family's largest part ask on, block by block, and, as Jaccard distance is a metric,
   only blocks whose distance from the first hub differs from their own by no more than the limit.

Links inside a task are reduced to a spanning forest; nothing emits all pairs of a group.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, shingle_sets, slices, small, spent
from .components import components

#: Sets in a block of a family, sets of a family that ask a block at once, and hubs of a large family.
BLOCK, ASKING, HUBS = 128, 512, 16
#: Elements and sets of a chunk of the index, about.
CHUNK, CHUNK_SETS = 1_000_000, 60_000
_MU = 0.0085  # DivideSkip's weight of a merge against a probe


# ---- candidates ------------------------------------------------------------------------------


def set_id(h: np.ndarray) -> int:
    """A 63-bit id of a set of hashes and its size."""
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little") >> 1


#: What tasks send each other: elements of a chunk that fall in a bucket, or (in a bucket below 0) the chunk itself.
_ROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.string()), ("a", pa.large_binary()), ("b", pa.large_binary()), ("c", pa.large_binary())])
_ROWS = "bucket int, chunk string, a binary, b binary, c binary"
_MANY = 0xFFFF  # instead of a set's number: the element occurs in several sets of the chunk


def _planes(x: np.ndarray) -> bytes:
    """Sorted numbers byte by byte, the high bytes together, which compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Chunk:
    """Sets of a task's documents, a bounded number: rows as (doc_id, known, n, sid), and each distinct set once."""

    def __init__(self, bits: int):
        self.bits, self.rows, self.number, self.sets, self.held = bits, [], {}, [], 0

    def add(self, doc_id: int | None, h: np.ndarray) -> None:
        sid = set_id(h) if len(h) else -1
        self.rows.append((doc_id or 0, doc_id is not None, len(h), sid))
        if doc_id is not None and len(h) and sid not in self.number:
            self.number[sid] = len(self.sets)
            self.sets.append(h >> np.uint64(32 - self.bits))  # an element's bucket and 32 more bits
            self.held += len(h)

    def full(self, elements: int) -> bool:
        return self.held >= elements or len(self.sets) >= CHUNK_SETS or len(self.rows) >= 4 * CHUNK_SETS

    def send(self, name: str) -> pa.RecordBatch:
        """A row for each bucket: its elements in order, the number of the set that holds each, and for elements of several
        sets how many; one more row for what only this chunk needs again: its documents, sets, and who shares an element."""
        size = np.array([len(s) for s in self.sets], np.int64)
        value = np.concatenate([*self.sets, np.empty(0, np.uint64)])
        order = np.argsort(value, kind="stable")
        value, own = value[order], np.repeat(np.arange(len(size)), size)[order]
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(value)))
        value, several = value[first], count > 1
        holder = np.where(several, _MANY, own[first]).astype(np.uint16)
        times = np.append(0, np.cumsum(several))
        many = count[several].astype(np.uint32)
        edge = np.searchsorted(value >> np.uint64(32), np.arange((1 << self.bits) + 1))
        out = []
        for b in np.flatnonzero(np.diff(edge)).tolist():
            low, high = edge[b], edge[b + 1]
            part = value[low:high] & np.uint64(0xFFFFFFFF)
            out.append({"bucket": b, "chunk": name, "a": _planes(part), "b": holder[low:high].tobytes(), "c": many[times[low] : times[high]].tobytes()})
        shared = np.concatenate([[several.sum()], value[several].astype(np.int64), many, own[np.repeat(several, count)]]).astype(np.int64)
        sets = np.array([list(self.number), size], np.int64)
        out.append({"bucket": -1 - zlib.crc32(name.encode()) % 1024, "chunk": name, "a": np.array(self.rows, np.int64).tobytes(), "b": sets.tobytes(), "c": shared.tobytes()})
        return pa.RecordBatch.from_pylist(out, _ROW)


def _enter(width: int, bits: int):
    """Documents -> chunks of the inverted index."""
    elements = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, chunk = TaskContext.get().partitionId(), 0, _Chunk(bits)
        for batch in slices(batches, 64):
            for i, h in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").to_pylist(), width), strict=True):
                chunk.add(i, h)
                if chunk.full(elements):
                    yield chunk.send(f"{part}-{number}")
                    number, chunk = number + 1, _Chunk(bits)
        if chunk.rows:
            yield chunk.send(f"{part}-{number}")

    return run


def _lengths(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """A bucket of the index: the lengths of its lists, and for each chunk those of its elements that have longer lists
    than one. Lengths are told as steps of a twelfth of a power of two, which order lists alike everywhere."""
    if rows[0]["bucket"] < 0:
        yield pa.RecordBatch.from_pylist(rows, _ROW)
        return
    values = [_unplaned(r["a"]) for r in rows]
    holders = [np.frombuffer(r["b"], np.uint16) for r in rows]
    weight = np.ones(sum(map(len, values)), np.int64)
    holder = np.concatenate(holders)
    weight[holder == _MANY] = np.concatenate([np.frombuffer(r["c"], np.uint32) for r in rows])
    value = np.concatenate(values)
    order = np.argsort(value, kind="stable")
    value = value[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    total = np.add.reduceat(weight[order], first)
    level = np.empty(len(value), np.uint8)
    level[order] = np.repeat(np.where(total > 1, np.minimum(255, 12 * np.log2(total)), 0).astype(np.uint8), np.diff(np.append(first, len(value))))
    out, end = [], 0
    for r, v, h in zip(rows, values, holders, strict=True):
        begin, end = end, end + len(v)
        mine = level[begin:end]
        one = (mine > 0) & (h != _MANY)
        out.append({"bucket": r["bucket"], "chunk": r["chunk"], "a": v[one].tobytes() + h[one].tobytes(), "b": mine[one].tobytes(), "c": mine[h == _MANY].tobytes()})
    yield pa.RecordBatch.from_pylist(out, _ROW)


_SHOWN = pa.schema([("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("z", pa.int64())])
KEY, PAIR, ROW, ROW_WITHOUT_ID = range(4)


def _short_lists(num: int, den: int):
    """A chunk and what the index says of its elements -> its documents (kinds ROW: doc_id, n, sid), the short lists that
    its sets are in (KEY: element, least sid) and the pairs of sets that meet within the chunk (PAIR: a, b)."""

    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        meta = next(r for r in rows if r["bucket"] < 0)
        docs, (sid, size) = np.frombuffer(meta["a"], np.int64).reshape(-1, 4), np.frombuffer(meta["b"], np.int64).reshape(2, -1)
        n, *shared = np.frombuffer(meta["c"], np.int64)
        shared = np.array(shared, np.int64)
        value, count, member = shared[:n], shared[n : 2 * n], shared[2 * n :]
        told = sorted((r for r in rows if r["bucket"] >= 0), key=lambda r: r["bucket"])
        level = np.concatenate([np.frombuffer(r["c"], np.uint8) for r in told] or [np.empty(0, np.uint8)])
        if len(level) != n:
            raise RuntimeError(f"the index lost a part of chunk {meta['chunk']}")
        own, element, length = [member], [np.repeat(value, count)], [np.repeat(level, count)]
        for r in told:
            m = len(r["b"])
            element.append(np.frombuffer(r["a"], np.uint32, m).astype(np.int64) | r["bucket"] << 32)
            own.append(np.frombuffer(r["a"], np.uint16, m, 4 * m).astype(np.int64))
            length.append(np.frombuffer(r["b"], np.uint8))
        own, element, length = map(np.concatenate, (own, element, length))
        order = np.lexsort((element, length, own))
        own, element = own[order], element[order]
        known = np.bincount(own, minlength=len(size))
        # a set's lists of one come first, so they fill so many of its short ones
        left = size - -(-num * size // den) + 1 - (size - known)
        place = np.arange(len(own)) - np.repeat(np.cumsum(known) - known, known)
        shown = place < left[own]
        key, least, a, b = stars(element[shown], sid[own[shown]])
        kinds = np.repeat([KEY, PAIR, ROW], [len(key), len(a), len(docs)])
        kinds[len(key) + len(a) :] += docs[:, 1] == 0
        x, y, z = np.concatenate([key, a, docs[:, 0]]), np.concatenate([least, b, docs[:, 2]]), np.concatenate([np.zeros(len(key) + len(a), np.int64), docs[:, 3]])
        yield pa.record_batch([pa.array(kinds.astype(np.int32)), pa.array(x), pa.array(y), pa.array(z)], schema=_SHOWN)

    return run


def stars(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (key, id): the keys, their least ids, and (least, other) for the further ids of a key, without repeats."""
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    if not len(key):
        return key, ids, ids, ids
    first = np.append(True, key[1:] != key[:-1])
    least = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    fresh = ids != least
    pairs = np.unique(np.stack([least[fresh], ids[fresh]]), axis=1) if fresh.any() else np.empty((2, 0), np.int64)
    return key[first], ids[first], pairs[0], pairs[1]


def _candidates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``docs(doc_id, text)`` -> a table of documents, short lists and pairs; see ``_short_lists``. Texts are read once."""
    # buckets and partitions follow the input, so that a task's part of the index stays within its memory
    parts = 2 * docs.rdd.getNumPartitions()
    bits = min(30, max(8, (4 * parts - 1).bit_length()))
    entered = docs.mapInArrow(_enter(width, bits), _ROWS)
    told = grouped(entered, "bucket", _lengths, _ROWS, None, parts)
    return cut(grouped(told, "chunk", _short_lists(num, den), "kind int, x long, y long, z long", None, parts))


def _pairs(shown: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of set ids that connect all sets that meet in a short list, and in how many (``n``) they meet."""
    keys = shown.where(F.col("kind") == KEY).select(F.col("x").alias("key"), F.col("y").alias("sid"))
    least = keys.groupBy("key").agg(F.min("sid").alias("a"), F.max("sid").alias("most")).where("a < most").drop("most")
    across = keys.join(least, "key").where("sid <> a").select("a", F.col("sid").alias("b"))
    within = shown.where(F.col("kind") == PAIR).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return across.union(within).groupBy("a", "b").agg(F.count("*").alias("n"))


# ---- search ----------------------------------------------------------------------------------


class Index:
    """Inverted lists over sets: for each hash the sorted places of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.sizes = np.array([len(s) for s in sets])
        h, place = np.concatenate(sets), np.repeat(np.arange(self.n), self.sizes)
        order = np.lexsort((place, h))
        h, self.place = h[order], place[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        self.keys, self.start = h[first], np.append(first, len(h))
        self.packed = np.repeat(np.arange(len(first)), np.diff(self.start)) * self.n + self.place  # sorted

    def overlaps(self, query: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of sets that may link with the query, by the least overlap T it allows, and their overlaps."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        least = -(-num * len(query) // den)  # T: the union is at least the query
        at = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        lists = at[self.keys[at] == query]
        if len(lists) < least:
            return none
        size = self.start[lists + 1] - self.start[lists]
        aside = min(least - 1, int(least / (_MU * math.log2(max(2, size.max())) + 1)))
        lists = lists[np.argsort(size, kind="stable")]
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        length = self.start[short + 1] - self.start[short]
        merged = self.place[np.repeat(self.start[short] - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())]
        count = np.bincount(merged, minlength=self.n)
        fits = (den * self.sizes >= num * len(query)) & (num * self.sizes <= den * len(query))
        found = np.flatnonzero((count >= max(1, least - aside)) & fits)
        if not len(found):
            return none
        probes = (long[:, None] * self.n + found).ravel()
        hit = np.minimum(np.searchsorted(self.packed, probes), len(self.packed) - 1)
        return found, count[found] + (self.packed[hit] == probes).reshape(len(long), len(found)).sum(axis=0)


def _forest(n: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those pairs that join parts not yet joined."""
    root, out = list(range(n)), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def grouped(df: DataFrame, key: str, run: Callable[[list[dict]], Iterator], schema: str, out: pa.Schema | None, parts: int | None = None) -> DataFrame:
    """``run`` over the rows of each value of ``key``, one value at a time, after one shuffle and a sort. It gives dicts in
    the schema ``out``, or Arrow batches if that is None. ``parts`` is the number of partitions, if not the session's."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def settled() -> Iterator[pa.RecordBatch]:
            made = run(rows)
            if out is None:
                yield from made
            elif made := list(made):
                yield pa.RecordBatch.from_pylist(made, out)

        for batch in slices(batches):
            for row in batch.to_pylist():
                if rows and row[key] != rows[0][key]:
                    yield from settled()
                    rows = []
                rows.append(row)
        if rows:
            yield from settled()

    dealt = df.repartition(parts, key) if parts else df.repartition(key)
    return dealt.sortWithinPartitions(key).mapInArrow(walk, schema)


def _search(num: int, den: int) -> Callable[[list[dict]], list[dict]]:
    """Rows of one unit (side 0: indexed, side 1: asking; without the latter all ask) -> a forest of links between them."""

    def run(rows: list[dict]) -> list[dict]:
        indexed = list({r["node"]: r for r in rows if r["side"] == 0}.values())
        asking = list({r["node"]: r for r in rows if r["side"] == 1}.values()) or indexed
        if not indexed:
            return []
        index = Index([np.frombuffer(r["hashes"], np.uint64) for r in indexed])
        number = {r["node"]: i for i, r in enumerate(indexed)}
        pairs = []
        for row in asking:
            h = np.frombuffer(row["hashes"], np.uint64)
            own = number.setdefault(row["node"], len(number))
            found, overlap = index.overlaps(h, num, den)
            good = found[den * overlap >= num * (len(h) + index.sizes[found] - overlap)]
            pairs += [(int(x), own) for x in good if x != own]
        names = list(number)
        return [{"a": names[x], "b": names[y]} for x, y in _forest(len(names), pairs)]

    return run


def _measure(num: int, den: int) -> Callable[[list[dict]], list[dict]]:
    """Rows of one block (side 0) and its family's hubs (side 1, the first of them 2) -> for each set its cell of distance
    from the first hub and the hubs it links with. Cells are (0, w], (w, 2w], ... with w the limit of linked sets."""

    def run(rows: list[dict]) -> list[dict]:
        sets = list({r["node"]: np.frombuffer(r["hashes"], np.uint64) for r in rows if r["side"] == 0}.items())
        size = np.array([len(s) for _, s in sets])
        flat = np.concatenate([s for _, s in sets])
        start = np.cumsum(size) - size
        cell, hubs = np.zeros(len(sets), np.int64), [[] for _ in sets]
        for row in {r["node"]: r for r in sorted(rows, key=lambda r: r["side"]) if r["side"]}.values():
            hub = np.frombuffer(row["hashes"], np.uint64)
            at = np.minimum(np.searchsorted(hub, flat), len(hub) - 1)
            both = np.add.reduceat((hub[at] == flat).astype(np.int64), start)
            either = size + len(hub) - both
            for i in np.flatnonzero(den * both >= num * either).tolist():
                if sets[i][0] != row["node"]:
                    hubs[i].append(row["node"])
            if row["side"] == 2 and den > num:
                cell = np.maximum(0, -(-((either - both) * den) // (either * (den - num))) - 1)
        return [{"node": node, "cell": c, "hubs": h} for (node, _), c, h in zip(sets, cell.tolist(), hubs, strict=True)]

    return run


_LINKS = "a long, b long", pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MEASURED = "node long, cell long, hubs array<long>", pa.schema([("node", pa.int64()), ("cell", pa.int64()), ("hubs", pa.list_(pa.int64()))])


def _upto(n: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)


def _links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``sets(node, fam, size, shared, hashes)`` -> links ``a, b`` of nodes that connect all sets that link."""
    few = sets.where(F.col("size") <= BLOCK).select(F.col("fam").alias("unit"), "node", "hashes", F.lit(0).alias("side"))
    links = grouped(few, "unit", _search(num, den), *_LINKS)
    many = sets.where(F.col("size") > BLOCK)
    if many.limit(1).count() == 0:
        return links
    # hubs: of each part of a family dealt by hash, the set that shares most; the first is the best of them
    parts = F.ceil(F.col("size") / BLOCK)
    best = F.struct("shared", -F.col("node"))
    hubs = many.groupBy("fam", F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("_part")).agg(F.max_by("node", best).alias("hub"), F.max(best).alias("_best"))
    hubs = hubs.withColumn("side", F.when(F.col("_best") == F.max("_best").over(Window.partitionBy("fam")), 2).otherwise(1)).select("hub", "side")
    hub_sets = cut(many.select("node", "fam", "size", "hashes").join(checked_broadcast(cut(hubs)), F.col("node") == F.col("hub")))
    own = many.select(F.xxhash64("fam", F.pmod(F.xxhash64("node"), parts)).alias("unit"), "node", "hashes", F.lit(0).alias("side"))
    asked = hub_sets.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).select(F.xxhash64("fam", "_p").alias("unit"), "node", "hashes", "side")
    measured = cut(grouped(own.union(asked), "unit", _measure(num, den), *_MEASURED))
    hub_links = cut(measured.select(F.explode("hubs").alias("a"), F.col("node").alias("b")))
    # what does not hang together with a family's largest part asks on
    part = components(hub_links).withColumnRenamed("id", "node")
    placed = cut(many.select("node", "fam").join(measured.select("node", "cell"), "node").join(part, "node", "left").withColumn("part", F.coalesce("component", "node")))
    largest = placed.groupBy("fam", "part").agg(F.count("*").alias("_n")).groupBy("fam").agg(F.max_by("part", F.struct("_n", -F.col("part"))).alias("largest"))
    asks = cut(placed.join(checked_broadcast(cut(largest)), "fam").where("part <> largest").select("node", "fam", "cell"))
    cells = placed.groupBy("fam", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asking = asks.groupBy("fam", "cell").agg(F.ceil(F.count("*") / ASKING).alias("turns")).select("fam", F.explode(F.array(F.col("cell") - 1, "cell", F.col("cell") + 1)).alias("cell"), F.col("cell").alias("from"), "turns")
    grid = cut(cells.join(asking, ["fam", "cell"]))
    hashes, near = many.select("node", "hashes"), checked_broadcast(grid)
    unit = lambda block, turn: F.xxhash64("fam", "cell", "from", block, turn)
    given = placed.select("node", "fam", "cell").join(near, ["fam", "cell"]).withColumn("turn", F.explode(_upto("turns")))
    given = given.select("node", unit(F.pmod(F.xxhash64("node"), F.col("blocks")), F.col("turn")).alias("unit"), F.lit(0).alias("side"))
    put = asks.withColumnRenamed("cell", "from").join(near, ["fam", "from"]).withColumn("block", F.explode(_upto("blocks")))
    put = put.select("node", unit(F.col("block"), F.pmod(F.xxhash64("node"), F.col("turns"))).alias("unit"), F.lit(1).alias("side"))
    return links.union(hub_links).union(grouped(given.union(put).join(hashes, "node"), "unit", _search(num, den), *_LINKS))


def jaccard_components(docs: DataFrame, *, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_shingles, component_id``, a row for each row.

    Two documents link when den * |intersection| >= num * |union| of their sets of distinct ``width``-word shingles (the
    whole text as one if it is shorter), 0 < num <= den; component_id is the least doc_id reachable. A null, empty or blank
    text has no shingles and links with nothing. Very long texts are read whole. A row with a null doc_id links with nothing
    and has a null component. Rows that repeat a doc_id are documents of their own. An empty table gives no rows; other
    columns are ignored.
    """
    if not 0 < num <= den:
        raise ValueError("the limit must be above 0 and at most 1")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shown = _candidates(slim, width, num, den)
    sid = F.when(F.col("z") >= 0, F.col("z")).alias("sid")
    known = shown.where(F.col("kind") >= ROW).select(F.when(F.col("kind") == ROW, F.col("x")).alias("doc_id"), F.col("y").alias("n_shingles"), sid)
    nodes = cut(known.where("doc_id is not null and sid is not null").groupBy("sid").agg(F.min("doc_id").alias("node")))
    pairs = cut(_pairs(shown))
    fam = cut(components(pairs).withColumnsRenamed({"id": "sid", "component": "fam"}))
    shared = pairs.select(F.col("b").alias("sid"), "n").union(pairs.select(F.col("a").alias("sid"), "n")).groupBy("sid").agg(F.sum("n").alias("shared"))
    # only sizes of large families matter; they are few, so the families' rows need not meet by family
    large = cut(fam.groupBy("fam").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK))
    sized = fam.join(checked_broadcast(large), "fam", "left").withColumn("size", F.coalesce("size", F.lit(BLOCK)).cast("long"))
    wanted = cut(sized.join(shared, "sid").join(nodes, "sid"))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            own = pa.array([set_id(h) if len(h) else None for h in sets], pa.int64())
            part = batch.drop_columns(["text", "doc_id"]).append_column("hashes", pa.array([h.tobytes() for h in sets], pa.binary()))
            yield part.filter(pc.equal(own, part.column("sid")))

    texts = slim.join(checked_broadcast(wanted), F.col("doc_id") == F.col("node"))
    loaded = texts.mapInArrow(load, "sid long, fam long, size long, shared long, node long, hashes binary")
    sets = cut(loaded.select("node", "fam", "size", "shared", "hashes"))
    found = cut(components(_links(sets, num, den)).withColumnsRenamed({"id": "node", "component": "least"}))
    spent(sets, pairs, fam, wanted)
    label = nodes.join(checked_broadcast(found), "node", "left").select(F.col("sid").alias("_sid"), F.coalesce("least", "node").alias("_c"))
    out = known.join(label, (F.col("sid") == F.col("_sid")) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("_c", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` whose document is the least of its component, one row for each; rows without words stay."""
    groups = jaccard_components(docs, **limits)
    kept = cut(groups.where("component_id <=> doc_id").select(F.col("doc_id").alias("_id")).distinct())
    # rows travel whole under one name, so that no column of theirs clashes with others
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"))
    return rows.join(checked_broadcast(kept), F.col("_doc").eqNullSafe(F.col("_id")), "left_semi").select("row.*")
