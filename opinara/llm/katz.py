"""A Katz backoff bigram model: Good-Turing discounts, exactly normalised backoff weights, and scores of whole texts.

    P(w)      = d(c) c / N           for words seen in training; what is left is the mass of an unknown word
    P(w | v)  = d(c) c(v w) / c(v)   for pairs seen; else a(v) P(w), with a(v) = (1 - seen mass) / (1 - sum of P(w) seen)

A text is its words and one end; its first context is a start mark. After an unknown context the pair falls to P(w).

Texts are tokenised once, in chunks of bounded size that the tasks write to the shared folder as arrays. A chunk then asks
two tables for what it holds: distinct words, then distinct pairs with their training counts. Tables are partitioned by
hash; a partition adds up what all chunks bring, and answers each chunk in the order it asked, so that answers need no keys
and a word or pair crosses the network once for each chunk, not for each token or document. A context with very many tokens
has its pairs dealt over all partitions by the second word; its sums, which are additive, are added up again later. With
the pair counts a partition returns what the backoff weights are made of, before discounts are known: for each asked
context the number of its pairs seen 1..K times, the count of the others, and the sum of P(w) over the pairs seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, mix, shared_dir, word_hashes

#: Discounts apply to counts up to K; tokens of a chunk; hashes of the start of a text, its end and an unknown word.
K, CHUNK = 5, 1_500_000
START, END = np.uint64(1), np.uint64(2)
#: A context is hot if it has more than one in so many of all tokens for each partition.
HOT = 8


@dataclass(frozen=True)
class Discounts:
    """Factors for counts 1..K, and up to which count ``k`` they discount: Katz's by Good-Turing for the greatest k up to K
    for which all are proper, between 0 and 1; if none is, as for a few texts, those of taking off half a count."""

    d: tuple[float, ...]
    k: int

    @staticmethod
    def of(n: list[int]) -> Discounts:
        """``n[r - 1]``: how many items were seen r times, for r up to K + 1."""
        for k in range(K, 0, -1):
            if min(n[: k + 1]) > 0 and (over := (k + 1) * n[k] / n[0]) < 1:
                d = tuple(((r + 1) * n[r] / (r * n[r - 1]) - over) / (1 - over) for r in range(1, k + 1))
                if all(0 < x < 1 for x in d):
                    return Discounts((*d, *(1.0,) * (K - k)), k)
        return Discounts(tuple((r - 0.5) / r for r in range(1, K + 1)), K)

    def __call__(self, c: np.ndarray) -> np.ndarray:
        """d(c) * c as doubles."""
        table = np.array([0.0, *self.d, 1.0])
        return table[np.minimum(c, K + 1)] * c


# ---- chunks ------------------------------------------------------------------------------------


def _put(uri: str, name: str, columns: dict[str, np.ndarray]) -> None:
    fs, base = pafs.FileSystem.from_uri(uri)
    fs.create_dir(base, recursive=True)
    own = f"{base}/{name}.{TaskContext.get().taskAttemptId()}"
    row = pa.record_batch({k: pa.array([v.tobytes()], pa.large_binary()) for k, v in columns.items()})
    with fs.open_output_stream(own) as f, ipc.new_stream(f, row.schema, options=ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(row)
    if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(f"{base}/{name}").type != pafs.FileType.NotFound:
        fs.delete_file(f"{base}/{name}")
    fs.move(own, f"{base}/{name}")


def _get(uri: str, name: str, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    fs, base = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(f"{base}/{name}") as f:
        row = ipc.open_stream(f).read_all()
    return {k: np.frombuffer(row.column(k)[0].as_py(), t) for k, t in kinds.items()}


_CHUNK = {"doc_id": np.int64, "known_id": np.bool_, "train": np.bool_, "size": np.int64, "token": np.uint32, "word": np.uint64}
_ROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.string()), ("key", pa.large_binary()), ("value", pa.large_binary())])
_ROWS = "bucket int, chunk string, key binary, value binary"


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte: equal high bytes stand together, which the shuffle's compression takes out."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _row(bucket: int, chunk: str, key: np.ndarray, value: np.ndarray) -> dict:
    return {"bucket": bucket, "chunk": chunk, "key": key.tobytes(), "value": value.tobytes()}


def _tokenise(docs: DataFrame, uri: str, buckets: int) -> DataFrame:
    """Write the chunks; a row for each chunk and bucket: its distinct words and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[np.ndarray] = []
        ids: list[int | None] = []
        held = number = 0

        def settle() -> pa.RecordBatch:
            size = np.array([len(t) + 1 for t in texts], np.int64)
            flat = np.full(size.sum(), END, np.uint64)
            inside = np.ones(len(flat), bool)
            inside[np.cumsum(size) - 1] = False
            flat[inside] = np.concatenate(texts)
            word, token = np.unique(flat, return_inverse=True)
            train = np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i in ids])
            count = np.bincount(token[np.repeat(train, size)], minlength=len(word)).astype(np.uint32)
            name = f"chunk-{TaskContext.get().partitionId():06d}-{number:04d}"
            _put(uri, name, {"doc_id": np.array([i or 0 for i in ids], np.int64), "known_id": np.array([i is not None for i in ids]), "train": train, "size": size, "token": token.astype(np.uint32), "word": word})
            edge = np.searchsorted(_bucket(word, buckets), np.arange(buckets + 1))
            return pa.RecordBatch.from_pylist([_row(b, name, word[edge[b] : edge[b + 1]], count[edge[b] : edge[b + 1]]) for b in range(buckets) if edge[b] < edge[b + 1]], _ROW)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    texts.append(np.maximum(word_hashes(text), np.uint64(3)))
                    ids.append(i)
                    held += len(texts[-1]) + 1
                    if held >= CHUNK:
                        yield settle()
                        texts, ids, held, number = [], [], 0, number + 1
        if texts:
            yield settle()

    return docs.mapInArrow(run, _ROWS)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hashes, so that sorted words are in order of bucket."""
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _by(df: DataFrame, key: str, parts: int, run, schema: str = _ROWS) -> DataFrame:
    """``run`` over the rows (lists of dicts) of each key after one shuffle; rows of a key are whole in one task. A bucket is
    a partition of its own."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row[key] != rows[0][key]:
                    yield from run(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from run(rows)

    dealt = df.repartitionById(parts, F.col(key)) if key == "bucket" else df.repartition(parts, key)
    return dealt.sortWithinPartitions(key).mapInArrow(walk, schema)


STATS = "*stats"


def _answers(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """A partition of the word table: add up counts, answer each chunk, and give the table's statistics."""
    keys = [np.frombuffer(r["key"], np.uint64) for r in rows]
    word, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, np.concatenate([np.frombuffer(r["value"], np.uint32) for r in rows]), len(word)).astype(np.uint32)
    ends = np.cumsum([len(k) for k in keys])
    out = [_row(r["bucket"], r["chunk"], np.empty(0), total[at[e - len(k) : e]]) for r, k, e in zip(rows, keys, ends, strict=True)]
    seen = total[total > 0]
    out.append(_row(rows[0]["bucket"], STATS, np.empty(0), np.array([seen.sum(), len(seen), *(np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2])], np.int64)))
    large = np.argsort(total, kind="stable")[::-1][:64]
    out.append(_row(rows[0]["bucket"], "*large", word[large], total[large].astype(np.int64)))
    yield pa.RecordBatch.from_pylist(out, _ROW)


@dataclass(frozen=True)
class Words:
    """The word table's statistics: tokens, distinct words, discounts, and what is left for an unknown word."""

    tokens: int
    types: int
    discounts: Discounts
    rest: float
    total: int

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounts(c) / self.total, self.rest)


def _pairs(chunk: dict[str, np.ndarray], count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The local number of each token's context, where the start mark is the number after the last word."""
    token = chunk["token"].astype(np.int64)
    before = np.append(0, token[:-1])
    before[np.append(0, np.cumsum(chunk["size"])[:-1])] = len(chunk["word"])
    return before, token


def _distinct(chunk: dict[str, np.ndarray], count: np.ndarray, hot: np.ndarray, buckets: int):
    """The distinct pairs of a chunk whose context is known, in order of partition, context and word.

    Returns local contexts, local words, training counts, partitions, and for each token its pair's place or -1."""
    before, token = _pairs(chunk, count)
    width = len(chunk["word"])
    known = np.append(count > 0, _starts(chunk, count) > 0)[before]
    pair, at = np.unique((before * width + token)[known], return_inverse=True)
    v, w = pair // width, pair % width
    n = np.bincount(at, np.repeat(chunk["train"], chunk["size"])[known], len(pair)).astype(np.uint32)
    names = np.append(chunk["word"], START)
    where = _bucket(mix(names[v] ^ np.where(np.isin(names[v], hot), mix(chunk["word"][w]), np.uint64(0))), buckets)
    order = np.lexsort((chunk["word"][w], names[v], where))
    place = np.full(len(token), -1, np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place[known] = rank[at]
    return v[order], w[order], n[order], where[order], place, before, token


def _load(uri: str, rows: list[dict]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """A chunk and its words' counts, from the answers of the word table in order of bucket."""
    own = sorted((r for r in rows if not len(r["key"])), key=lambda r: r["bucket"])
    return _get(uri, rows[0]["chunk"], _CHUNK), np.concatenate([np.frombuffer(r["value"], np.uint32) for r in own])


def _ask(uri: str, hot: np.ndarray, buckets: int):
    """A chunk's distinct pairs with known contexts: context, 56 bits of the word, training count, the word's count."""

    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        chunk, count = _load(uri, rows)
        v, w, n, where, *_ = _distinct(chunk, count, hot, buckets)
        names = np.append(chunk["word"], START)[v]
        start = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (where[1:] != where[:-1])))[: len(v)]
        length = np.diff(np.append(start, len(v)))
        edge = np.searchsorted(where, np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = edge[b], edge[b + 1]
            if lo < hi:
                s = slice(*np.searchsorted(start, (lo, hi)))
                times = n[lo:hi]
                word = _planes(chunk["word"][w[lo:hi]])[hi - lo :]
                parts = [_planes(names[start[s]]), _planes(length[s].astype(np.uint32)), word, _planes(np.minimum(times, 255).astype(np.uint8)), _planes(count[w[lo:hi]]), times[times >= 255].tobytes()]
                yield pa.RecordBatch.from_pylist([{"bucket": b, "chunk": rows[0]["chunk"], "key": np.array([s.stop - s.start, hi - lo], np.int64).tobytes(), "value": b"".join(parts)}], _ROW)

    return run


def _read_ask(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    contexts, pairs = np.frombuffer(row["key"], np.int64)
    data, at, out = row["value"], 0, []
    for kind, n in ((np.uint64, contexts), (np.uint32, contexts), (np.uint64, pairs), (np.uint8, pairs), (np.uint32, pairs)):
        n, width = int(n), np.dtype(kind).itemsize
        planes, sent = np.zeros((width, n), np.uint8), 7 if len(out) == 2 else width  # a word comes without its last byte
        planes[width - sent :] = np.frombuffer(data, np.uint8, n * sent, at).reshape(sent, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * sent
    name, length, word, n, c = out
    n = n.astype(np.uint32)
    n[n == 255] = np.frombuffer(data, np.uint32, -1, at)
    return name, length, word, n, c


_MADE = np.dtype([("low", "<u4", (K,)), ("more", "<f8"), ("below", "<f8")])  # of a context: see the module's text


def _pair_answers(words: Words, hot: np.ndarray, keep: str | None):
    """A partition of the pair table: add up counts; answer each chunk with its pairs' counts and its contexts' sums."""

    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        asked = [_read_ask(r) for r in rows]
        name = np.concatenate([np.repeat(a[0], a[1]) for a in asked])
        word, n, c = (np.concatenate([a[i] for a in asked]) for i in (2, 3, 4))
        order = np.lexsort((word, name))
        first = np.append(True, (name[order][1:] != name[order][:-1]) | (word[order][1:] != word[order][:-1]))
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        total = np.bincount(group, n, first.sum()).astype(np.uint32)
        names, below = name[order][first], words.p(c[order][first])
        if keep:
            _put(keep, f"pairs-{rows[0]['bucket']:06d}", {"context": names, "word": word[order][first], "count": total})
        # sums for each context over its pairs seen in training
        context, of = np.unique(names, return_inverse=True)
        made = np.zeros(len(context), _MADE)
        for r in range(1, K + 1):
            made["low"][:, r - 1] = np.bincount(of, total == r, len(context))
        made["more"] = np.bincount(of, np.where(total > K, total, 0), len(context))
        made["below"] = np.bincount(of, np.where(total > 0, below, 0), len(context))
        least, end = np.where(made["low"].any(axis=1), (made["low"] > 0).argmax(axis=1) + 1, 255).astype(np.uint8), 0
        for r, a in zip(rows, asked, strict=True):
            begin, end = end, end + len(a[2])
            got = total[group[begin:end]]
            # with the counts go the least count that a context's pairs have, if it is K or less, and its sums, the latter
            # only to contexts that have a pair not seen in training
            unseen = np.logical_or.reduceat(got == 0, np.append(0, np.cumsum(a[1].astype(np.int64))[:-1]))
            sums = made[np.searchsorted(context, a[0][unseen])]
            small = np.minimum(got, 255).astype(np.uint8)
            yield pa.RecordBatch.from_pylist([{"bucket": r["bucket"], "chunk": r["chunk"], "key": np.array([len(got), unseen.sum()], np.int64).tobytes(), "value": small.tobytes() + got[got >= 255].tobytes() + sums.tobytes() + np.packbits(unseen).tobytes() + least[np.searchsorted(context, a[0])].tobytes()}], _ROW)
        seen = total[total > 0]
        yield pa.RecordBatch.from_pylist([_row(rows[0]["bucket"], STATS, np.empty(0), np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2].astype(np.int64))], _ROW)
        mine = np.isin(context, hot)
        if mine.any():
            yield pa.RecordBatch.from_pylist([_row(rows[0]["bucket"], "*hot", context[mine], made[mine])], _ROW)

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, words_k int, pairs_k int"


def _score(uri: str, words: Words, pairs: Discounts, hot: np.ndarray, hot_sums: np.ndarray, buckets: int):
    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        chunk, count = _load(uri, rows)
        v, _, _, where, place, before, token = _distinct(chunk, count, hot, buckets)
        names = np.append(chunk["word"], START)
        got, sums, some_low = np.zeros(len(v), np.int64), np.zeros(len(names), _MADE), np.zeros(len(names), bool)
        edge = np.searchsorted(where, np.arange(buckets + 1))
        for r in rows:
            if not len(r["key"]):
                continue
            data, lo = r["value"], edge[r["bucket"]]
            n, m = (int(x) for x in np.frombuffer(r["key"], np.int64))
            c = np.frombuffer(data, np.uint8, n).astype(np.int64)
            large = c == 255
            c[large] = np.frombuffer(data, np.uint32, int(large.sum()), n)
            got[lo : lo + n] = c
            own = v[lo : lo + n]
            context = own[np.append(True, own[1:] != own[:-1])]
            at = n + 4 * int(large.sum())
            bits = np.frombuffer(data, np.uint8, (len(context) + 7) // 8, at + m * _MADE.itemsize)
            sums[context[np.unpackbits(bits, count=len(context)).astype(bool)]] = np.frombuffer(data, _MADE, m, at)
            some_low[context] = np.frombuffer(data, np.uint8, len(context), at + m * _MADE.itemsize + len(bits)) <= pairs.k
        here = np.isin(names, hot)
        sums[here] = hot_sums[np.searchsorted(hot, names[here])]
        some_low[here] = sums["low"][here][:, : pairs.k].any(axis=1)
        # a context whose pairs all are frequent gives nothing up by discounts, so one more token stands for the unseen
        total = np.append(count, _starts(chunk, count)) + np.where(some_low, 0.0, 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            mass = (sums["low"] @ (np.array(pairs.d) * np.arange(1, K + 1)) + sums["more"]) / total
            weight = (1 - mass) / (1 - sums["below"])
        below, c = words.p(count)[token], np.where(place >= 0, got[place] if len(got) else 0, -1)
        p = np.where(c > 0, pairs(np.maximum(c, 0)) / total[before], np.where(c == 0, weight[before], 1.0) * below)
        base = np.log10((count + 0.5) / (words.tokens + 0.5 * (words.types + 1)))[token]
        at = np.append(0, np.cumsum(chunk["size"])[:-1])
        out = {
            "doc_id": pa.array(chunk["doc_id"], mask=~chunk["known_id"]), "held_out": pa.array(~chunk["train"]), "n_tokens": pa.array(chunk["size"]),
            "n_known": pa.array(np.add.reduceat((count > 0)[token].astype(np.int64), at)), "train_tokens": pa.array(np.full(len(at), words.tokens)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(np.log10(p), at)),
            "words_k": pa.array(np.full(len(at), words.discounts.k, np.int32)), "pairs_k": pa.array(np.full(len(at), pairs.k, np.int32)),
        }
        yield pa.record_batch(out)

    return run


def _starts(chunk: dict[str, np.ndarray], count: np.ndarray) -> int:
    """Training texts: as many as ends."""
    return int(count[np.searchsorted(chunk["word"], END)])


def _sum(rows: list, kind: type = np.int64) -> np.ndarray:
    return np.sum([np.frombuffer(bytes(r["value"]), kind) for r in rows], axis=0)


def _hot_words(answers: DataFrame, tokens: int, buckets: int) -> DataFrame:
    """``key`` of the words that are more than one in HOT * buckets of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                many = np.frombuffer(row["value"], np.int64) * HOT * buckets > tokens
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["key"], np.int64)[many])], names=["key"])

    return answers.where(F.col("chunk") == "*large").select("key", "value").mapInArrow(run, "key long")


def _hot_sums(pair_answers: DataFrame) -> DataFrame:
    """Each hot context with its sums over all partitions of the pair table."""
    names = [*(f"low{r}" for r in range(1, K + 1)), "more", "below"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = np.frombuffer(row["value"], _MADE)
                parts = [*made["low"].astype(np.float64).T, made["more"], made["below"]]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["key"], np.int64)), *map(pa.array, parts)], names=["key", *names])

    rows = pair_answers.where(F.col("chunk") == "*hot").select("key", "value")
    return rows.mapInArrow(run, "key long, " + ", ".join(f"{n} double" for n in names)).groupBy("key").agg(*(F.sum(n).alias(n) for n in names))


def katz_scores(docs: DataFrame, *, buckets: int | None = None, keep: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, for each row.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1 and scores all. Words are lower-cased (A-Z) and told apart
    by 64-bit hashes, by 56 bits of them among those that follow one context. ``base_score``: sum of log10((c + 0.5) / (N + 0.5 (V + 1))); ``score``: the model's log10
    probability; ``words_k`` and ``pairs_k``: up to which count the discounts go. Very long texts are scored whole. A null text is empty (one token, the end); a null doc_id counts as ''; repeated rows are texts of their
    own; with no training row all words are unknown; an empty table gives no rows; other columns are ignored. ``buckets``
    is the number of table partitions and changes no result. With ``keep`` the pair table is stored in that folder too.
    """
    spark: SparkSession = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    uri = shared_dir(spark)
    parts = 2 * slim.rdd.getNumPartitions()
    buckets = buckets or max(16, 2 * parts)  # they follow the input's size
    answers = cut(_by(_tokenise(slim, uri, buckets), "bucket", buckets, _answers))
    stats = answers.where(F.col("chunk") == STATS).select("value").collect()  # a row of a few numbers for each bucket
    if not stats:
        return spark.createDataFrame([], _SCORES)
    tokens, types, *n = (int(x) for x in _sum(stats))
    words = _words(tokens, types, n)
    # of a share of all tokens each, so no more than HOT * buckets of them
    found = [r["key"] % 2**64 for r in _hot_words(answers, tokens, buckets).collect()]
    hot = np.unique(np.array([int(START), *found], np.uint64))
    chunks = answers.where(F.col("chunk").startswith("chunk"))
    pair_answers = cut(_by(_by(chunks, "chunk", parts, _ask(uri, hot, buckets)), "bucket", buckets, _pair_answers(words, hot, keep)))
    pair_stats = pair_answers.where(F.col("chunk") == STATS).select("value").collect()
    pairs = Discounts.of([int(x) for x in _sum(pair_stats)] if pair_stats else [0] * (K + 1))
    hot_sums = np.zeros(len(hot), _MADE)
    for key, *sums in _hot_sums(pair_answers).collect():  # a row for each hot context
        at = np.searchsorted(hot, np.uint64(key % 2**64))
        hot_sums["low"][at], hot_sums["more"][at], hot_sums["below"][at] = sums[:K], sums[K], sums[K + 1]
    rows = chunks.union(pair_answers.where(F.col("chunk").startswith("chunk")))
    return _by(rows, "chunk", parts, _score(uri, words, pairs, hot, hot_sums, buckets), schema=_SCORES)


def _words(tokens: int, types: int, n: list[int]) -> Words:
    discounts = Discounts.of(n)
    low = sum((r + 1) * x for r, x in enumerate(n[:K]))
    total = tokens + (not low)  # see the contexts' one more token
    seen = sum(d * (r + 1) * x for r, (d, x) in enumerate(zip(discounts.d, n, strict=False))) + tokens - low
    return Words(tokens, types, discounts, 1 - seen / total, total)
