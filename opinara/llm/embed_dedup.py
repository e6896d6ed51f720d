"""Near-duplicate vectors by int8-quantised tile products with rigorous error bounds.

Equal vectors are one node. Nodes are stored once, in small blocks by group, and each pair of groups is one unit: its task
reads the two groups from the shared folder and compares them tile by tile, so no vector is shuffled for a comparison. A
unit vector x is x = s * q + r with q int8 and e = |r| known for each vector, so the product of two vectors
differs from s_x * s_y * (q_x . q_y) by at most e_x + e_y + e_x * e_y. Integer products below 2**24 are exact in single
precision, so BLAS multiplies them. Pairs that the bound leaves possibly above the threshold are computed again in double
precision; only those link. A tile returns link counts of its vectors and a spanning forest of its links, never the pairs.

The work is all pairs of distinct vectors, in tiles. What is shuffled and written grows with the vectors, twice and once;
groups, bounded in bytes, are read once for each other group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, give_back, shared_dir, spent
from .components import components
from .ngram_join import grouped

#: Vectors of a stored block, of a tile's side and of the smallest group; bytes of the largest group in double precision.
STORED, GROUP, GROUP_BYTES = 256, 2048, 32 << 20
#: Units for each core, where there are vectors enough, and tasks at most.
UNITS_PER_CORE, UNIT_TASKS = 4, 10_000
#: Products recomputed at once; more than any rounding of the single precision comparison.
PAIRS, SLACK = 65_536, 1e-5


def levelled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to 0.5 to 1, so that no product of two over- or underflows;
    cosines stay as they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows of levelled x as int8 values (held as float32), their scales, and the norm of what quantisation leaves out."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127
    q = np.rint(unit / scale[:, None])
    left = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q.astype(np.float32), scale.astype(np.float32), left


def tile(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs with cosine >= threshold, in parts; only i < j if x and y are the same rows."""
    x, y = levelled(x), levelled(y)
    (qx, sx, ex), (qy, sy, ey) = quantise(x), quantise(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    span = max(1, (1 << 24) // (127 * 127))  # dimensions whose integer products stay exact
    p = qx[:, :span] @ qy[:, :span].T
    for at in range(span, x.shape[1], span):
        p += qx[:, at : at + span] @ qy[:, at : at + span].T
    # e_x + e_y + e_x e_y, where the last is at most half the squares' sum
    bx, by = ex + ex**2 / 2, ey + ey**2 / 2
    # first a bound for a whole row, by the largest scale and error of y, which one pass compares; then each pair's own
    need = threshold - SLACK - bx - by.max()
    i, j = np.nonzero(p >= np.where(need > 0, need / (sx.astype(np.float64) * sy.max()) * (1 - 1e-5), -np.inf).astype(np.float32)[:, None])
    open_ = p[i, j].astype(np.float64) * sx[i] * sy[j] + bx[i] + by[j] >= threshold - SLACK
    i, j = i[open_], j[open_]
    if same:
        i, j = i[i < j], j[i < j]
    for at in range(0, len(i), PAIRS):
        a, b = i[at : at + PAIRS], j[at : at + PAIRS]
        good = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
        yield a[good], b[good]


def _pack(rows: list[dict]) -> list[dict]:
    out = []
    for dim in {len(r["vector"]) for r in rows}:
        own = [r for r in rows if len(r["vector"]) == dim]
        pack = lambda v, t: np.array(v, t).tobytes()
        out.append({"block": own[0]["block"], "dim": dim, "nodes": pack([r["node"] for r in own], np.int64), "weights": pack([r["weight"] for r in own], np.int64), "data": pack([r["vector"] for r in own], own[0]["kind"])})
    return out


def _group(folder: str, g: int, kind: str) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A stored group: nodes, weights and vectors by number of dimensions."""
    store, base = pafs.FileSystem.from_uri(folder)
    found = store.get_file_info(pafs.FileSelector(f"{base}/_g={g}", allow_not_found=True))
    rows = []
    for info in sorted(found, key=lambda x: x.path):
        if info.base_name.endswith(".parquet"):
            with store.open_input_file(info.path) as f:
                rows += pq.ParquetFile(f).read(["dim", "nodes", "weights", "data"]).to_pylist()
    out = {}
    for dim in sorted({r["dim"] for r in rows}):
        own = [r for r in rows if r["dim"] == dim]
        get = lambda name, t, own=own: np.concatenate([np.frombuffer(r[name], t) for r in own])
        out[dim] = get("nodes", np.int64), get("weights", np.int64), get("data", kind).reshape(-1, dim)
    return out


def _compare(threshold: float, folder: str, groups: int, kind: str):
    """Units (numbers low * groups + high) -> a forest of the links between two groups, and what each vector's links count."""
    side = GROUP

    def unit(left: dict, right: dict, same: bool) -> Iterator[pa.RecordBatch]:
        for dim in sorted(set(left) & set(right)):
            (nx, wx, x), (ny, wy, y) = left[dim], right[dim]
            cx = np.zeros(len(x), np.int64)
            cy = cx if same else np.zeros(len(y), np.int64)
            root = np.arange(len(x) + (0 if same else len(y)))
            for s in range(0, len(x), side):
                for t in range(s if same else 0, len(y), side):
                    for i, j in tile(x[s : s + side].astype(np.float64), y[t : t + side].astype(np.float64), threshold, same and s == t):
                        i, j = i + s, j + t
                        np.add.at(cx, i, wy[j])
                        np.add.at(cy, j, wx[i])
                        tie(root, i, j if same else j + len(x))
            names = nx if same else np.concatenate([nx, ny])
            counts = cx if same else np.concatenate([cx, cy])
            top, some = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(names[top]), pa.array(names[root[top]]), pa.array(np.zeros(len(top), np.int64))], ["a", "b", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.nulls(len(some), pa.int64()), pa.array(counts[some])], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, dict] = (-1, {})
        for batch in batches:
            for number in batch.column(0).to_pylist():
                low, high = divmod(number, groups)
                if held[0] != low:
                    held = low, _group(folder, low, kind)
                yield from unit(held[1], held[1] if low == high else _group(folder, high, kind), low == high)
        give_back()

    return run


def tie(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the parts of a and b in ``root``, in which every place points straight at the least of its part."""
    while True:
        x, y = root[a], root[b]
        if not (x != y).any():
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.95, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``vec_id, n_links, component_id, kept``, a row for each row.

    n_links counts the other rows whose cosine with the row's vector, in double precision, is at least ``threshold``
    (equal vectors included); component_id is the least id reachable by links; kept is vec_id = component_id. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing, as do vectors of other lengths. Rows
    with a null id link with nothing and have a null component. Rows that repeat an id are vectors of their own and may
    link with each other. An empty table gives no rows; other columns are ignored.
    """
    kind = "<f4" if "float" in vectors.schema[vector].dataType.simpleString() else "<f8"
    spark = vectors.sparkSession
    given = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)) & F.exists("v", lambda x: x != 0)
    given = given.withColumn("v", F.when(F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull(), F.col("v")))
    # equal vectors are told by 128 bits of two hashes, so that a vector itself moves only to be stored
    given = given.withColumns({"_k": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "_l": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))})
    nodes = cut(given.where("v is not null").groupBy("_k", "_l").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.max(F.size("v")).alias("dim")))
    n, dim = nodes.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    # enough groups for all cores, none smaller than a tile's side or larger than its bytes allow
    least = max(1, -(-n * dim * 8 // GROUP_BYTES))
    groups = max(least, min(-(-n // GROUP), math.isqrt(2 * UNITS_PER_CORE * spark.sparkContext.defaultParallelism) + 1))
    blocks = groups * max(1, -(-n // (groups * STORED)))
    first = given.where("v is not null").join(nodes.drop("dim").withColumnRenamed("node", "vec_id"), ["_k", "_l", "vec_id"]).dropDuplicates(["_k", "_l", "vec_id"])
    placed = first.select(F.col("vec_id").alias("node"), "weight", F.col("v").alias("vector"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.lit(kind).alias("kind"))
    stored = grouped(placed, "block", _pack, "block long, dim int, nodes binary, weights binary, data binary", pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("nodes", pa.binary()), ("weights", pa.binary()), ("data", pa.binary())]))
    folder = shared_dir(spark)
    stored.withColumn("_g", F.col("block") % groups).write.partitionBy("_g").parquet(folder)
    units = groups * (groups + 1) // 2
    pairs = spark.range(0, groups, 1, min(groups, UNIT_TASKS)).select(F.explode(F.sequence(F.col("id") * groups + F.col("id"), F.col("id") * groups + groups - 1)).alias("unit"))
    dealt = pairs.repartitionByRange(min(units, UNIT_TASKS), "unit").sortWithinPartitions("unit")
    found = cut(dealt.mapInArrow(_compare(threshold, folder, groups, kind), "a long, b long, n long"))
    stored._table = folder
    spent(stored)
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    tied = components(found.where("b is not null").select("a", "b"))
    about = nodes.join(counts, F.col("node") == F.col("a"), "left").join(tied, F.col("node") == F.col("id"), "left")
    about = about.select(F.col("_k").alias("_x"), F.col("_l").alias("_y"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("_n"), F.coalesce("component", "node").alias("_c"))
    out = given.drop("v").join(about, (F.col("_k") == F.col("_x")) & (F.col("_l") == F.col("_y")), "left")
    whole = F.coalesce("_c", "vec_id")
    return out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), whole.alias("component_id"), F.coalesce(F.col("vec_id") == whole, F.lit(True)).alias("kept"))
