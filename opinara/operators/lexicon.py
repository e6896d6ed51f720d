"""Phrases of a large lexicon in texts: hashes of the phrases, in parts on shared storage, looked up at every place of a text.

A lexicon of a few phrases is better said as expressions (``functions.text.lexicon_hits``). Here it is a table. Spark makes it
distinct, numbers the phrases in their order, hashes each, orders the table by length and hash and stores it in parts of
bounded size in the folder that all machines share; nothing of it reaches the driver but the files' names. A task searches
its texts in slabs of bounded size: hashes of all windows of one length come from one running sum, and the parts pass by one
after another, so neither the lexicon nor the hits of many texts are ever held as a whole. What a hash finds is compared byte
by byte. As parts are in order of length, a slab is gone over once for each length and part. Texts are told in UTF-8, in which
a phrase's bytes are found exactly where its characters are. Their hits are many times their bytes, so a table of few
partitions is dealt over all cores first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.sources.logs import _stored, shared_folder

#: Characters of a part's phrases and phrases of a part, about.
PART_CHARS, PART_PHRASES = 8_000_000, 1_000_000
#: Bytes of a phrase that are hashed: a longer one is found by these and then compared.
HASHED = 64
#: Bytes of texts that are searched at once, of a part's piece in memory, and of pieces that a worker may keep.
SLAB, PIECE, KEPT = 1 << 19, 16 << 20, 16 << 20
#: Hits compared at once, and hits told at once.
COMPARED, TOLD = 1 << 16, 1 << 17
#: Tasks for each core, as texts differ in length.
TASKS_PER_CORE = 4
HIT = "struct<grp:string,phrase:string>"
_BASE = 0x9E3779B97F4A7C15
_NUMBERS = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
#: Powers of the base and of its inverse modulo 2**64, as many as were asked for.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Pieces of a small lexicon by its files' names.
_KEPT: dict[str, list[pa.RecordBatch]] = {}


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            each = np.full(n, base, np.uint64)
            each[0] = 1
            _POWERS[k] = np.cumprod(each)
    return _POWERS


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts end to end, and where each begins (and all end); a null has none."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """phrase, groups, o -> with k, the bytes hashed, and h, their hash."""
    for batch in batches:
        raw, at = _bytes(batch.column("phrase"))
        k = np.minimum(np.diff(at), HASHED)
        h = np.zeros(len(k), np.uint64)
        for n in np.unique(k[k > 0]):
            own = np.flatnonzero(k == n)
            h[own] = (_NUMBERS[raw[at[own][:, None] + np.arange(n)]] * _powers(HASHED)[0][:n]).sum(axis=1, dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k, pa.int32()), pa.array(h.view(np.int64))], [*batch.schema.names, "k", "h"])


def parts_of(lexicon: DataFrame, part_chars: int = PART_CHARS, part_phrases: int = PART_PHRASES) -> list[str]:
    """Files with the distinct phrases of ``lexicon(grp, phrase)`` and their groups, in order of length and hash."""
    spark, folder = lexicon.sparkSession, shared_folder(lexicon.sparkSession)
    whole = lexicon.where(F.col("phrase").isNotNull()).select(F.col("phrase").cast("string").alias("phrase"), "grp").groupBy("phrase").agg(F.array_sort(F.collect_set(F.col("grp").cast("string"))).alias("groups"))
    schema = "phrase string, groups array<string>, o long, k int, h long"
    ordered = whole.repartitionByRange("phrase").sortWithinPartitions("phrase").withColumn("o", F.monotonically_increasing_id())
    ordered.mapInArrow(_hashed, schema).write.parquet(f"{folder}/all")
    every = spark.read.schema(schema).parquet(f"{folder}/all")
    chars, n = every.agg(F.coalesce(F.sum(F.length("phrase")), F.lit(0)), F.count("*")).first()
    every.repartitionByRange(max(1, -(-chars // part_chars), -(-n // part_phrases)), "k", "h").sortWithinPartitions("k", "h").write.parquet(f"{folder}/parts")
    store, place = _stored(folder)
    store.delete_dir(f"{place}/all")
    return sorted(f"{folder}/parts/{x.base_name}" for x in store.get_file_info(fs.FileSelector(f"{place}/parts")) if x.base_name.endswith(".parquet") and n)


def _pieces(files: list[str]) -> Iterator[pa.RecordBatch]:
    """The parts in pieces of bounded bytes, one at a time; a worker keeps those of a small lexicon."""
    key = files[0]
    if key in _KEPT:
        yield from _KEPT[key]
        return
    held, size = [], 0
    for path in files:
        store, place = _stored(path)
        with store.open_input_file(place) as f:
            table = pq.ParquetFile(f, read_dictionary=["groups.list.element"])
            rows, total = table.metadata.num_rows, sum(table.metadata.row_group(i).total_byte_size for i in range(table.metadata.num_row_groups))
            for piece in table.iter_batches(max(1, min(rows, rows * PIECE // max(1, total))), use_threads=False):
                size += piece.nbytes
                held = [*held, piece] if size <= KEPT else []
                yield piece
    if size <= KEPT:
        _KEPT.clear()
        _KEPT[key] = held


def _found(raw: np.ndarray, ends: np.ndarray, own: np.ndarray, sums: np.ndarray, some: np.ndarray, piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in the piece) of the phrases that texts hold, each once. ``own`` is the text of each byte, ``sums`` the
    running sum of their hashes, ``some`` the texts that are not null."""
    lengths, h = piece.column("k").to_numpy(), piece.column("h").to_numpy()
    told, at = _bytes(piece.column("phrase"))
    size, inverse = np.diff(at), _powers(len(raw) + 1)[1]
    edge = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(lengths)]
    texts, places = [], []
    for low, high in zip(edge, edge[1:], strict=False):
        k = int(lengths[low]) if high > low else 0
        if high > low and not k:  # the empty phrase
            texts.append(some)
            places.append(np.full(len(some), low))
        if not k or k > len(raw):
            continue
        keys = h[low:high]
        windows = ((sums[k:] - sums[:-k]) * inverse[: len(raw) - k + 1]).view(np.int64)
        shift = np.uint64(64 - min(23, (8 * len(keys)).bit_length()))
        known = np.zeros(1 << (64 - int(shift)), bool)
        known[keys.view(np.uint64) >> shift] = True
        pos = np.flatnonzero(known[windows.view(np.uint64) >> shift])
        asked = windows[pos]
        which = np.searchsorted(keys, asked)
        while len(pos):  # phrases of one hash follow one another
            same = which < len(keys)
            same[same] = keys[which[same]] == asked[same]
            pos, asked, which = pos[same], asked[same], which[same]
            for s in range(0, len(pos), COMPARED):
                p, w = pos[s : s + COMPARED], which[s : s + COMPARED] + low
                inside = p + size[w] <= ends[own[p]]
                p, w = p[inside], w[inside]
                if k < HASHED:
                    rows = told[at[low] : at[high]].reshape(-1, k)
                    good = (raw[p[:, None] + np.arange(k)] == rows[w - low]).all(axis=1)
                else:
                    good = np.array([np.array_equal(raw[x : x + size[y]], told[at[y] : at[y + 1]]) for x, y in zip(p.tolist(), w.tolist(), strict=True)], bool)
                pair = np.unique(own[p[good]].astype(np.int64) * len(lengths) + w[good])
                texts.append(pair // len(lengths))
                places.append(pair % len(lengths))
            which = which + 1
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pair = np.unique(np.concatenate(texts) * len(lengths) + np.concatenate(places))
    return pair // len(lengths), pair % len(lengths)


def _search(texts: pa.Array, files: list[str]) -> Iterator[pa.Array]:
    """The hits of each text of a slab, by all parts, in order of group and phrase; in arrays of about TOLD hits."""
    raw, at = _bytes(texts)
    own = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_NUMBERS[raw] * _powers(len(raw) + 1)[0][: len(raw)], out=sums[1:])
    null = texts.is_null().to_numpy(zero_copy_only=False)
    # the pool: phrases found anywhere in the slab, the codes of their groups and their order
    pairs, pool, order, times, codes, names, n = [], [pa.array([], pa.string())], [], [], [], {}, 0
    for piece in _pieces(files):
        text, place = _found(raw, at[1:], own, sums, np.flatnonzero(~null), piece)
        found, entry = np.unique(place, return_inverse=True)
        pairs.append((text.astype(np.int32), (entry + n).astype(np.int32)))
        n += len(found)
        lists = piece.column("groups").take(pa.array(found))
        pool.append(piece.column("phrase").take(pa.array(found)))
        order.append(piece.column("o").to_numpy()[found])
        times.append(lists.value_lengths().to_numpy())
        told = lists.flatten()
        known = np.array([names.setdefault(g, len(names)) for g in told.dictionary.to_pylist()], np.int64)
        codes.append(known[told.indices.to_numpy()] if len(told) else np.empty(0, np.int64))
    pool, sort = pa.concat_arrays(pool), np.argsort(np.concatenate([*order, np.empty(0, np.int64)]))
    pool, rank = pool.take(pa.array(sort)), np.empty(n, np.int64)
    rank[sort] = np.arange(n)
    times, codes = np.concatenate([*times, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*codes, np.empty(0, np.int64)])
    first = np.append(0, np.cumsum(times))[:-1][sort]
    times = times[sort]
    groups = sorted(names, key=lambda g: g.encode())
    place_of = np.empty(len(names), np.int64)
    place_of[[names[g] for g in groups]] = np.arange(len(names))
    codes, groups = place_of[codes], pa.array([None if g == "-" else g[1:] for g in groups], pa.string())
    n, g = max(1, n), max(1, len(groups))
    pair = np.sort(np.concatenate([t.astype(np.int64) * n + rank[e] for t, e in pairs] + [np.empty(0, np.int64)]))
    edge = np.searchsorted(pair, np.arange(len(texts) + 1) * n)
    held = np.append(0, np.cumsum(times[pair % n]))[edge]
    low = 0
    while low < len(texts):
        high = max(low + 1, min(int(np.searchsorted(held, held[low] + TOLD, "right")) - 1, low + (1 << 62) // (n * g)))
        text, entry = np.divmod(pair[edge[low] : edge[high]], n)
        several = times[entry]
        flat = np.repeat(first[entry] - np.cumsum(several) + several, several) + np.arange(several.sum())
        key = np.sort((np.repeat(text - low, several) * g + codes[flat]) * n + np.repeat(entry, several))
        hits = pa.StructArray.from_arrays([groups.take(pa.array(key // n % g)), pool.take(pa.array(key % n))], ["grp", "phrase"])
        yield pa.ListArray.from_arrays(pa.array(held[low : high + 1] - held[low], pa.int32()), hits, mask=pa.array(null[low:high]))
        low = high


def _slabs(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The same texts, in arrays of SLAB bytes or a little more, or of one text."""
    held, size = [], 0
    for batch in texts:
        at, low = _bytes(batch)[1], 0
        while low < len(batch):
            high = max(low + 1, int(np.searchsorted(at, at[low] + SLAB - size, "right")) - 1)
            held.append(batch.slice(low, high - low).cast(pa.string()))
            size, low = size + int(at[high] - at[low]), high
            if size >= SLAB or low < len(batch):
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def lexicon_table_hits(df: DataFrame, lexicon: DataFrame, text: str = "text", part_chars: int = PART_CHARS, part_phrases: int = PART_PHRASES) -> DataFrame:
    """``df`` with ``hits``: the (grp, phrase) of ``lexicon(grp, phrase)`` whose phrase a lower-case copy of the text holds,
    anywhere, in order of grp, then phrase.

    A null text has null hits; the empty phrase is in every text; null phrases go; a phrase of several groups is told for
    each, and for a null group under null. The lexicon is stored when this is called, texts are searched when rows are asked.
    """
    named = lexicon.select(F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit("-")).alias("grp"), "phrase")
    low, spark = F.lower(F.col(text)), df.sparkSession
    dealt = df.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    files = parts_of(named, part_chars, part_phrases)

    @F.arrow_udf(f"array<{HIT}>")
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for slab in _slabs(texts):
            yield from _search(slab, files)
            pa.default_memory_pool().release_unused()

    return dealt.withColumn("hits", find(low) if files else F.when(F.col(text).isNotNull(), F.array().cast(f"array<{HIT}>")))
