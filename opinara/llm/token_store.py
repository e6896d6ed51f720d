"""Token ids in Arrow stream files: batches of fixed-size lists that a reader maps into memory and slices without copies.

``write_token_files`` encodes whole texts, ends each document with one id and packs the ids of a range of doc_ids into
sequences of equal length, one stream file for each range. Every full batch has the same number of sequences, so sequence
``i`` is row ``i % rows`` of batch ``i // rows``; only the last sequence of a file is padded, and ``mask`` says where.
Beside it an index file holds ``doc_id, start, n_tokens`` within the file. ``read_documents`` and ``sequences`` read back.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, shared_dir
from .pieces import PieceCache, split_safe

MANIFEST = "shard long, n_docs long, n_tokens long, n_sequences long"
_CACHES: dict[tuple, PieceCache] = {}


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def _encoder(path: str, dtype: str):
    """A function from pieces to the bytes of their ids, and one that cuts texts into pieces. A run of letters, maybe with a comma or stop behind, is a single
    match of the splitting pattern (and the mark another), so it goes to the library's BPE model at once; all other pieces
    go through the library's whole encoder."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    if tokenizer.get_vocab_size() > np.iinfo(dtype).max + 1:
        raise ValueError(f"ids of {path} do not fit {dtype}")
    made = json.loads(tokenizer.to_str())
    before = made["pre_tokenizer"] or {}
    cuttable = made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    code = {2: "H", 4: "I", 8: "Q"}[np.dtype(dtype).itemsize]
    packed = lambda ids: array(code, ids).tobytes()
    whole = lambda ps: [packed(e.ids) for e in tokenizer.encode_batch_fast(ps, add_special_tokens=False)]
    if not cuttable:  # whole texts, each by itself
        return lambda texts: whole(texts) if texts else [], lambda text: [text]
    model, letters = tokenizer.model, _byte_letters()
    line_end = whole(["\n"])[0]
    tails = dict(zip(("", ",", "."), whole(["", ",", "."]), strict=True))

    def encode(pieces: list[str]) -> list[bytes]:
        out, rest = [b""] * len(pieces), []
        for k, piece in enumerate(pieces):
            lead = b""
            if piece[:1] == "\n" and len(piece) > 1:  # a line end before another character is a match by itself
                lead, piece = line_end, piece[1:]
            tail = piece[-1:] if piece[-1:] in (",", ".") else ""
            head = piece[: len(piece) - len(tail)]
            body = head[1:] if head[:1] == " " else head
            if body.isalpha() and max(body) < "\u0250":
                form = "".join([letters[b] for b in head.encode()]) if not head.isascii() else "\u0120" + body if len(head) > len(body) else body
                out[k] = lead + packed([t.id for t in model.tokenize(form)]) + tails[tail]
            else:
                rest.append(k)
        for k, made in zip(rest, whole([pieces[k] for k in rest]) if rest else [], strict=True):
            out[k] = made
        return out

    return encode, split_safe


def _cache(path: str, dtype: str) -> PieceCache:
    """One cache for each worker process and tokenizer file."""
    if (path, dtype) not in _CACHES:
        encode, cut = _encoder(path, dtype)
        _CACHES[path, dtype] = PieceCache(encode, entries=800_000, cut=cut)
    return _CACHES[path, dtype]


class _Packer:
    """Collects ids and writes each full batch of sequences at once, so that memory stays at a batch and a document."""

    def __init__(self, sink, dtype: str, length: int, rows: int):
        self.dtype, self.length, self.rows, self.held, self.size, self.written = np.dtype(dtype), length, rows, [], 0, 0
        item = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = ipc.new_stream(sink, self.schema)

    def add(self, parts: list[bytes]) -> None:
        self.held += parts
        self.size += sum(map(len, parts))
        if self.size >= (step := self.rows * self.length * self.dtype.itemsize):
            data = b"".join(self.held)
            full = len(data) - len(data) % step
            for at in range(0, full, step):
                self._write(np.frombuffer(data[at : at + step], self.dtype), self.rows * self.length)
            self.held, self.size = [data[full:]], len(data) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.out.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)], schema=self.schema))
        self.written += len(ids) // self.length

    def close(self) -> int:
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        if len(ids):
            self._write(np.concatenate([ids, np.zeros(-len(ids) % self.length, self.dtype)]), len(ids))
        self.out.close()
        return self.written


def _names(base: str, shard: int) -> tuple[str, str]:
    return f"{base}/tokens-{shard:06d}.arrow", f"{base}/index-{shard:06d}.arrow"


def write_token_files(docs: DataFrame, tokenizer: str, out: str | None = None, *, length: int = 2048, rows: int = 16, end_id: int = 0, dtype: str = "uint16") -> tuple[str, DataFrame]:
    """Write ``docs(doc_id, text)`` in ascending doc_id order; returns the folder and its manifest, a row for each file.

    A null text is empty and gives the end id alone; a null doc_id sorts first; rows with equal ids follow each other
    ordered by text; other columns are ignored; an empty table writes no file. Files are moved into place when whole, so a
    task that runs again replaces its own file by an equal one.
    """
    spark = docs.sparkSession
    out = out or shared_dir(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, cache = context.partitionId(), _cache(tokenizer, dtype)
        fs, base = pafs.FileSystem.from_uri(out)
        fs.create_dir(base, recursive=True)
        data, index = _names(base, shard)
        own = f".{context.taskAttemptId()}"
        end, width, ids, sizes, sink, packer = np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize, [], [], None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if packer is None:
                    sink = fs.open_output_stream(data + own)
                    packer = _Packer(sink, dtype, length, rows)
                for parts in cache.encode_batch([t or "" for t in part.column("text").to_pylist()]):
                    parts.append(end)
                    sizes.append(sum(map(len, parts)) // width)
                    packer.add(parts)
                ids += part.column("doc_id").to_pylist()
        if packer is None:
            return
        n_sequences = packer.close()
        sink.close()
        start = np.cumsum([0, *sizes[:-1]])
        with fs.open_output_stream(index + own) as f, ipc.new_stream(f, table := pa.table({"doc_id": pa.array(ids, pa.int64()), "start": start, "n_tokens": pa.array(sizes, pa.int64())}).schema) as w:
            w.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "start": start, "n_tokens": pa.array(sizes, pa.int64())}, schema=table))
        for name in (data, index):
            if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(name).type != pafs.FileType.NotFound:
                fs.delete_file(name)
            fs.move(name + own, name)
        yield pa.record_batch({"shard": [shard], "n_docs": [len(ids)], "n_tokens": [sum(sizes)], "n_sequences": [n_sequences]})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return out, cut(placed.mapInArrow(write, MANIFEST))


def _open(uri: str, shard: int) -> tuple[pa.NativeFile, pa.NativeFile]:
    fs, base = pafs.FileSystem.from_uri(uri)
    data, index = _names(base, shard)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(data), pa.memory_map(index)
    return fs.open_input_file(data), fs.open_input_file(index)


def sequences(uri: str, shard: int) -> pa.Table:
    """All sequences and masks of a file; slices of the result share the mapped file's memory."""
    return ipc.open_stream(_open(uri, shard)[0]).read_all()


def read_documents(spark: SparkSession, out: str, manifest: DataFrame) -> DataFrame:
    """Read the files back: ``doc_id, start`` (ids before it over all files), ``n_tokens, ids_crc32`` of each document."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = cut(manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, offset in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                data, index = _open(out, shard)
                docs = ipc.open_stream(index).read_all()
                blocks = (b.column("ids").flatten().to_numpy() for b in ipc.open_stream(data))
                held, crcs = np.empty(0, np.uint16), []
                for n in docs.column("n_tokens").to_pylist():
                    crc = 0
                    while n:
                        if not len(held):
                            held = next(blocks)
                        take = held[:n]
                        crc, held, n = zlib.crc32(take.astype("<u4").tobytes(), crc), held[len(take) :], n - len(take)
                    crcs.append(crc)
                yield from pa.table({"doc_id": docs.column("doc_id"), "start": pa.array(docs.column("start").to_numpy() + offset), "n_tokens": docs.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())}).to_batches()

    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
