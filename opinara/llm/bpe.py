"""Byte-level BPE over rank files, encoded and decoded by recursive DuckDB queries inside each Spark partition.

Each worker process keeps one in-memory database with two tables made from the rank file: ``vocab(id, hex)`` and
``merges(l, r, made)``, where ``made`` is the id (so the rank) of the bytes of ``l`` and ``r`` together. A recursive query
holds a row for each word and token position; at every step the rows of a word join ``merges`` with their neighbour, and
the leftmost pair of least rank is contracted, until no pair of the word is left. Ordered aggregation over the
result lists the ids and, through ``vocab``, decodes them: the bytes of the ids in order of position. Only words that the process has not met are sent to the database.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back
from .pieces import PATTERN, PieceCache, split_safe

#: A row is a token with the place and id of the one that follows it. ``best`` packs rank, place and following place.
ENCODE = """
WITH RECURSIVE step(word, pos, id, nxt, nxt_id, live) AS (
    SELECT word, pos, id, nxt, nxt_id, true FROM fresh
  UNION ALL
    (WITH now AS (SELECT word, pos, id, nxt, nxt_id FROM step WHERE live),
     best AS (
        SELECT n.word, min(m.made::BIGINT * 70368744177664 + n.pos * 8388608 + n.nxt) AS b
        FROM now n JOIN merges m ON m.l = n.id AND m.r = n.nxt_id GROUP BY n.word),
     pick AS (
        SELECT b.word, (b // 70368744177664)::INTEGER AS made, (b // 8388608) % 8388608 AS pos, b % 8388608 AS gone, r.nxt, r.nxt_id
        FROM best b JOIN now r ON r.word = b.word AND r.pos = b.b % 8388608)
     SELECT n.word, n.pos, CASE WHEN n.pos = p.pos THEN p.made ELSE n.id END,
            CASE WHEN n.pos = p.pos THEN p.nxt ELSE n.nxt END,
            CASE WHEN n.pos = p.pos THEN p.nxt_id WHEN n.nxt = p.pos THEN p.made ELSE n.nxt_id END, p.word IS NOT NULL
     FROM now n LEFT JOIN pick p ON p.word = n.word
     WHERE p.word IS NULL OR n.pos <> p.gone)
)
SELECT word, count(*) AS n, string_agg(s.id::VARCHAR, ',' ORDER BY pos) AS said, string_agg(v.hex, '' ORDER BY pos) AS back
FROM step s JOIN vocab v ON v.id = s.id WHERE NOT live GROUP BY word
"""

#: Every way to cut a token's bytes into two tokens.
MERGES = """
CREATE TABLE merges AS
SELECT a.id AS l, b.id AS r, v.id AS made
FROM (SELECT id, hex, unnest(range(1, len(hex) // 2)) AS at FROM vocab) v
JOIN vocab a ON a.hex = v.hex[: 2 * v.at] JOIN vocab b ON b.hex = v.hex[2 * v.at + 1 :]
"""

#: Bytes of a word above which it is contracted by itself.
LONG = 1024
#: Pieces of text that a worker remembers, and a third more words; with the tables some 700 MB at most, 250 MB for 200,000.
REMEMBER = 900_000
_CODERS: dict[tuple[str, str, int], PieceCache] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Coder:
    """``encode(words)`` gives for each word (a match of the splitting pattern) its ids and the decoded bytes."""

    def __init__(self, ranks: dict[bytes, int], batch: int = 20_000):
        import duckdb

        self.ranks, self.batch = ranks, batch
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "100MB"})
        self.db.register("given", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [v.hex() for v in ranks]}))
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM given")
        self.db.unregister("given")
        self.db.execute(MERGES)
        self.pairs: dict[tuple[int, int], int] | None = None  # only for very long words
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def encode(self, words: list[bytes]) -> list[tuple[int, str, bytes]]:
        out: list[tuple[int, str, bytes]] = []
        part, size = [], 0
        for w in words:  # batches bounded by the rows they make as well as by words
            if len(w) > LONG:
                out += self._encode(part) if part else []
                out.append(self._encode_long(w))
                part, size = [], 0
                continue
            part.append(w)
            size += len(w) ** 2  # the query keeps the rows of all its steps
            if len(part) >= self.batch or size >= 200 * self.batch:
                out += self._encode(part)
                part, size = [], 0
        return out + (self._encode(part) if part else [])

    def _encode(self, words: list[bytes]) -> list[tuple[int, str, bytes]]:
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes := [len(w) for w in words])
        ids, ends = self.byte[np.frombuffer(b"".join(words), np.uint8)], np.cumsum(sizes) - 1
        pos = np.arange(len(ids)) - np.repeat(ends + 1 - sizes, sizes)
        nxt_id = np.append(ids[1:], np.int32(-1))
        nxt_id[ends] = -1
        fresh = pa.table({"word": word, "pos": pos, "id": ids, "nxt": pos + 1, "nxt_id": nxt_id})
        self.db.register("fresh", fresh)
        got = self.db.execute(ENCODE).fetchnumpy()
        out: list[tuple[int, str, bytes]] = [(0, "", b"")] * len(words)
        for k, n, said, back in zip(got["word"].tolist(), got["n"].tolist(), got["said"].tolist(), got["back"].tolist(), strict=True):
            out[k] = (n, said, bytes.fromhex(back))
        return out

    def _encode_long(self, word: bytes) -> tuple[int, str, bytes]:
        """The same contractions for one very long word, for which a step for each would be too many: pairs wait in a heap
        by rank and place, and a contraction only renews the pairs beside it."""
        if self.pairs is None:
            self.bytes = {i: b for b, i in self.ranks.items()}
            self.pairs = dict(((a, b), c) for a, b, c in self.db.execute("SELECT l, r, made FROM merges").fetchall())
        ids = self.byte[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(made, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (made := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            made, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two is gone
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (rank := self.pairs.get((ids[x], ids[after[x]]))) is not None:
                    heapq.heappush(heap, (rank, x, ids[x], ids[after[x]]))
        out = [i for i in ids if i >= 0]
        return len(out), ",".join(map(str, out)), b"".join(self.bytes[i] for i in out)


def _coder(path: str, pattern: str, remember: int = REMEMBER) -> PieceCache:
    if (path, pattern, remember) not in _CODERS:
        import regex

        split, coder, words, known = regex.compile(pattern), Coder(read_ranks(path)), {}, pattern == PATTERN

        def cut_words(piece: str) -> list[str]:
            """The matches of the pattern; a run of letters, maybe with a comma or stop behind, is told without it."""
            lead = ["\n"] if piece[:1] == "\n" and len(piece) > 1 else []
            rest = piece[len(lead) :]
            tail = [rest[-1]] if rest[-1:] in (",", ".") and len(rest) > 1 else []
            head = rest[: len(rest) - len(tail)]
            body = head[1:] if head[:1] == " " else head
            if known and body.isalpha() and max(body) < "\u0250":
                return [*lead, head, *tail]
            return split.findall(piece)

        def encode(pieces: list[str]) -> list[tuple[int, str, bytes]]:
            cut = [cut_words(p) for p in pieces]
            if len(words) > remember * 4 // 3:
                words.clear()
            new = list({w for ws in cut for w in ws} - words.keys())
            words.update(zip(new, coder.encode([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
            made = [[words[w] for w in ws] for ws in cut]
            for w in [w for w in new if len(w) > 64]:
                del words[w]
            return [m[0] if len(m) == 1 else (sum(x[0] for x in m), ",".join(x[1] for x in m), b"".join(x[2] for x in m)) for m in made]

        _CODERS[path, pattern, remember] = PieceCache(encode, entries=remember, cut=split_safe if known else lambda t: [t])
    return _CODERS[path, pattern, remember]


def encode_documents(docs: DataFrame, ranks: str, pattern: str, *, keep_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if ``keep_ids``, ``ids array<int>``
    and the ``decoded`` text.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes that the ids decode to. A null
    text is empty and has no ids; a null doc_id stays; equal rows give equal rows; very long texts and words are encoded
    whole; an empty table gives no rows; other columns are ignored. ``remember`` bounds a worker's memory, not the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks, pattern, remember)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part, n, ids, back, full = batch.slice(at, 1024), [], [], [], []
                for made in coder.encode_batch([t or "" for t in part.column("text").to_pylist()], at_once=True):
                    if not made[0][0]:  # only the first piece can be empty
                        del made[0]
                    said, raw = ",".join([m[1] for m in made]), b"".join([m[2] for m in made])
                    n.append(said.count(",") + 1 if said else 0)
                    ids.append(hashlib.sha256(said.encode()).hexdigest())
                    back.append(hashlib.sha256(raw).hexdigest())
                    if keep_ids:
                        full.append(([int(x) for x in said.split(",")] if said else [], raw.decode("utf-8", "replace")))
                more = [pa.array([x[0] for x in full], pa.list_(pa.int32())), pa.array([x[1] for x in full])] if keep_ids else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(back), *more], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])])
        give_back()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids)
