"""Counting byte-level BPE tokens without making them: a heap of adjacent pairs over a linked list of symbols.

A word's symbols form a linked list, its adjacent pairs that may merge a heap by rank, then place. The least pair is popped
and merged, which only renews the pairs beside it, until no pair is left: the word has as many tokens as it had symbols,
less the merges. No ids are looked up or kept. Words are cut by the vocabulary's own rule; a worker remembers the counts of
a bounded number of short pieces of text, so that each is merged once.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices
from .pieces import PieceCache, split_safe

#: Pieces of text that a worker remembers, some 200 MB; words met inside them are as many at most.
REMEMBER = 900_000
#: Characters of a word above which its count is not remembered.
LONGEST = 64
_COUNTERS: dict[tuple[str, int], Counter] = {}


def tokens_of(word: str, ranks: dict[tuple[str, str], int]) -> int:
    """The tokens of one word of symbols: its symbols less the merges that ``ranks`` allows, least rank first, then leftmost."""
    n = len(word)
    if n < 2:
        return n
    symbol, before, after, merges = list(word), list(range(-1, n - 1)), [*range(1, n), -1], 0
    rank = ranks.get
    heap = [(r, i) for i, pair in enumerate(zip(word, word[1:])) if (r := rank(pair)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if symbol[i] is None or j < 0 or rank((symbol[i], symbol[j])) != r:
            continue  # one of the two has been merged otherwise since
        symbol[i] += symbol[j]
        symbol[j], k = None, after[j]
        after[i] = k
        merges += 1
        if k >= 0:
            before[k] = i
            if (r := rank((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class Counter:
    """Token counts of whole texts for one vocabulary file of byte-level BPE."""

    def __init__(self, path: str, remember: int = REMEMBER):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, cut, added = said["model"], said["pre_tokenizer"] or {}, said["added_tokens"]
        plain = not any((said["normalizer"], model.get("dropout"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"), model.get("byte_fallback"), model.get("ignore_merges"), cut.get("add_prefix_space")))
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError(f"{path} is not plain byte-level BPE")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        #: Strings that are one token wherever they stand in a text, the longest first.
        self.special = re.compile("|".join(sorted((re.escape(t["content"]) for t in added), key=len, reverse=True))) if added else None
        self.words: dict[str, int] = {}
        self.remember = remember
        self.pieces = PieceCache(self._pieces, entries=remember, cut=split_safe)

    def _word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = tokens_of(word, self.ranks)
            if len(word) <= LONGEST:
                self.words[word] = n
        return n

    def _pieces(self, pieces: list[str]) -> list[int]:
        if len(self.words) > self.remember:
            self.words.clear()
        return [sum(self._word(w) for w, _ in self.cut(p)) for p in pieces]

    def count(self, texts: list[str]) -> list[int]:
        # a special string is one token by itself, and the text on either side of it is cut as if it stood alone
        parts = [self.special.split(t) if self.special else [t] for t in texts]
        made = iter(self.pieces.encode_batch([x for p in parts for x in p], at_once=True))
        return [len(p) - 1 + sum(sum(next(made)) for _ in p) for p in parts]


def _counter(path: str, remember: int) -> Counter:
    if (path, remember) not in _COUNTERS:
        _COUNTERS[path, remember] = Counter(path, remember)
    return _COUNTERS[path, remember]


def count_tokens(docs: DataFrame, vocabulary: str, *, limit: int = 1024, remember: int = REMEMBER) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_bytes, n_tokens, over_limit``: UTF-8 bytes, tokens, and whether those are more
    than ``limit``.

    Nothing is shuffled: each partition counts its rows. A null or empty text has no bytes and no tokens; very long texts
    and words are counted whole; a null doc_id stays; repeated rows give a row each; an empty table gives none; other
    columns, whatever their names, are ignored. ``remember`` bounds a worker's memory, not the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary, remember)
        for part in slices(batches):
            text = pc.fill_null(part.column("text"), "")
            n = pa.array(counter.count(text.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pc.cast(pc.binary_length(text), pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        give_back()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
