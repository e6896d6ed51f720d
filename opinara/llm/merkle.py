"""A Merkle manifest of a dataset as a persistent, path-copying tree, built and versioned block by block.

Leaves are rows, ordered within a group; every two consecutive nodes have a parent, a last one alone too, until one node
remains, the group's root; the roots of the groups, in order, have a tree of their own. Places come from a range
partitioning and the counts of its parts, so no group passes through one task. 2**height leaves at aligned places are one
block, packed into a row; its tree is built by itself and its root is a leaf of the next, smaller round, until a group has
one block. Going back down, each block learns the siblings on its way to the root.

A version of the tree is made by changing one leaf: the new version shares all nodes but the leaf's ancestors, which are
copied, first within the block, then above it from the shared siblings that the block has learned. Blocks do this side by
side, so versions are as distributed as leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, spent

#: Levels of a block's tree: a packed block has at most 2**HEIGHT leaves, some 100 KB.
HEIGHT = 10
#: Ways of siblings (about 1 KB each) that may be broadcast, once counted; more are joined by shuffle.
WAYS = 20_000
#: Parts into which equal leaves of one id are dealt.
SALTS = 1024


def digest(*parts: str) -> str:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """The tree of one block, kept level by level, and the way from its root to the whole tree's root.

    ``height`` is the number of levels to rise, or None to rise until one node remains. A way names for each level the
    sibling and its side: ``<digest`` to the left, ``>digest`` to the right, nothing if the node is alone.
    """

    def __init__(self, leaves: list[str], height: int | None = None, above: list[str] = ()):
        self.levels, self.above = [leaves], list(above)
        while len(self.levels[-1]) > 1 if height is None else len(self.levels) <= height:
            low = self.levels[-1]
            self.levels.append([digest(*low[i : i + 2]) for i in range(0, len(low), 2)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def way(self, i: int) -> list[str]:
        """Siblings of leaf ``i`` within the block, level by level, then those above the block."""
        out = []
        for level in self.levels[:-1]:
            j = i ^ 1
            out.append(("<" if j < i else ">") + level[j] if j < len(level) else "")
            i >>= 1
        return out + self.above

    def version(self, i: int, leaf: str) -> list[str]:
        """The copied ancestors of leaf ``i`` once it is ``leaf``, up to the new root; all other nodes are shared."""
        return climb(leaf, self.way(i))


def climb(leaf: str, way: list[str]) -> list[str]:
    """The nodes from ``leaf`` (not itself) up along a way; the last is the root, or none if the leaf is the tree."""
    out = []
    for sibling in way:
        leaf = digest(sibling[1:], leaf) if sibling[:1] == "<" else digest(leaf, sibling[1:])
        out.append(leaf)
    return out


def _each_block(schema: str, of: Callable[[dict], Iterator[tuple]]) -> Callable[[DataFrame], DataFrame]:
    """Rows made from packed blocks, one block at a time in Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (block,) = batch.slice(at, 1).to_pylist()
                if rows := list(of(block)):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[x.split()[0] for x in schema.split(", ")])

    return lambda df: df.mapInArrow(run, schema)


def placed(nodes: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``nodes`` with ``at``, the place of each within its group ``g`` by ``order``, and ``total``, the group's size.

    Parts of a range partitioning number their rows; the counts of all parts give each part's first place in each group.
    Rows alike in all of ``order`` are dealt over SALTS ranges, as they may be many and any order of them will do.
    """
    names = nodes.columns
    dealt = nodes.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)))
    dealt = dealt.repartitionByRange("g", *order, "salt").sortWithinPartitions("g", *order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            own = []
            for g in batch.column("g").to_pylist():
                n = n + 1 if g == last else 0
                last = g
                own.append(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([part] * len(own), pa.int32()), pa.array(own, pa.int64())], names=[*names, "part", "own"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    rows = cut(dealt.select(*names).mapInArrow(number, f"{kinds}, part int, own long"))
    parts = rows.groupBy("g", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut(parts.select("g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("g")).alias("total")))
    out = rows.join(checked_broadcast(firsts), ["g", "part"]).select(*names, (F.col("first") + F.col("own")).alias("at"), "total")
    out._made = (rows, firsts)
    return out


def packed(nodes: DataFrame, height: int, *columns: str) -> DataFrame:
    """A row ``g, block, total, nodes`` for each aligned block: the nodes' ``columns`` in order of place."""
    return nodes.groupBy("g", F.shiftright("at", height).alias("block")).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("at", *columns))).alias("nodes"))


def _tree(block: dict, name: str, height: int, above: list[str] = ()) -> Tree:
    return Tree([n[name] for n in block["nodes"]], None if block["total"] <= 1 << height else height, above)


def grown(blocks: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """From packed blocks with ``digest``: (``g, root`` of each group, ``g, block, way`` of each block to its group's root)."""
    roots = lambda b: iter([(b["g"], b["block"], -(-b["total"] >> height), _tree(b, "digest", height).root)])
    tops = cut(_each_block("g string, at long, total long, digest string", roots)(blocks))
    if tops.where("total > 1").isEmpty():
        return tops.select("g", F.col("digest").alias("root")), tops.select("g", F.col("at").alias("block"), F.array().cast("array<string>").alias("way"))
    # groups of one block are through; the others' block roots are the leaves of the next round
    upper = cut(packed(tops.where("total > 1"), height, "digest"))
    root, way = grown(upper, height)

    def ways(b: dict) -> Iterator[tuple]:
        tree = _tree(b, "digest", height, b["way"])
        return ((b["g"], n["at"], tree.way(n["at"] & (1 << height) - 1)) for n in b["nodes"])

    below = _each_block("g string, block long, way array<string>", ways)(upper.join(checked_broadcast(way, WAYS), ["g", "block"]))
    done = tops.where("total <= 1")
    both = cut(below.unionByName(done.select("g", F.col("at").alias("block"), F.array().cast("array<string>").alias("way"))))
    return root.unionByName(done.select("g", F.col("digest").alias("root"))), both


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    said = value.cast("string")
    return F.when(said.isNull(), "-").otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


@dataclass
class Manifest:
    """``blocks``: packed leaves with the way of each block to the dataset's root. ``groups``: g, group, subroot."""

    blocks: DataFrame
    groups: DataFrame
    root: str
    height: int


def manifest(leaves: DataFrame, height: int = HEIGHT) -> Manifest | None:
    """The tree over ``leaves(grp string, id long, leaf string, tampered string)``; None over no rows.

    Groups ascend bytewise, null first; within one, leaves ascend by id, nulls first, rows of one id by their digests.
    """
    marked = leaves.select(F.when(F.col("grp").isNull(), "-").otherwise(F.concat(F.lit("="), "grp")).alias("g"), "id", "leaf", "tampered")
    rows = placed(marked, ("id", "leaf", "tampered"))
    blocks = cut(packed(rows, height, "id", "leaf", "tampered"))
    spent(*rows._made)
    trees = blocks.select("g", "block", "total", F.transform("nodes", lambda n: F.struct(n["at"].alias("at"), n["leaf"].alias("digest"))).alias("nodes"))
    subroots, ways = grown(trees, height)
    subroots = cut(subroots)
    if subroots.isEmpty():
        return None
    # the groups' roots have a tree of their own, by the same steps
    top = placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("own_g"), F.col("root").alias("digest")), ("own_g",))
    upper = cut(packed(top, height, "own_g", "digest"))
    spent(*top._made)
    whole, over = grown(upper.select("g", "block", "total", F.transform("nodes", lambda n: F.struct(n["at"].alias("at"), n["digest"].alias("digest"))).alias("nodes")), height)

    def onward(b: dict) -> Iterator[tuple]:
        tree = _tree(b, "digest", height, b["way"])
        return ((n["own_g"], n["digest"], tree.way(n["at"] & (1 << height) - 1)) for n in b["nodes"])

    groups = cut(_each_block("g string, subroot string, onward array<string>", onward)(upper.join(checked_broadcast(over, WAYS), ["g", "block"])))
    (root,) = whole.select("root").head()
    ways = ways.join(checked_broadcast(groups, WAYS), "g").select("g", "block", "subroot", F.concat("way", "onward").alias("way"))
    return Manifest(blocks.join(checked_broadcast(ways, WAYS), ["g", "block"]), groups.select("g", F.expr("if(g = '-', null, substring(g, 2))").alias("grp"), "subroot"), root, height)


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied long"


def proofs(tree: Manifest) -> DataFrame:
    """For each leaf its proof and the root of its version: a tampered leaf's own, else the tree as it is."""
    root, height = tree.root, tree.height

    def each(b: dict) -> Iterator[tuple]:
        block = _tree(b, "leaf", height, b["way"])
        for i, n in enumerate(b["nodes"]):
            proof = digest(*(s[1:] for s in block.way(i)))
            new = block.version(i, n["tampered"] or n["leaf"])
            folded = new[-1] if new else n["tampered"] or n["leaf"]
            yield n["id"], n["leaf"], b["subroot"], root, proof, folded, folded == root, len(new) if n["tampered"] else 0

    return _each_block(PROOF, each)(tree.blocks)


def tampered_documents(docs: DataFrame) -> DataFrame:
    """``grp, id, leaf, tampered`` of documents: leaves are digests of doc_id, source, lang, n_chars and text; where 7
    divides the CRC-32 of the decimal doc_id, ``tampered`` is the leaf once 1 is added to n_chars, if that is not null."""
    doc = lambda more: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long") + more, F.col("text"))
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return docs.select(F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("id"), doc(0).alias("leaf"), F.when(hit, doc(1)).alias("tampered"))


def verify_documents(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``docs(doc_id, source, lang, n_chars, text)`` -> ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``
    and ``copied``, the nodes that the leaf's version has of its own. ``height`` sets the size of blocks, not the result.

    A null value is a leaf's ``-``, a null lang a group before all others; nulls among doc_ids come first, are not tampered,
    and rows of one doc_id are ordered by their digests; repeated rows are leaves each; empty and very long texts are hashed
    whole and go no further; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    tree = manifest(tampered_documents(docs), height)
    return docs.sparkSession.createDataFrame([], PROOF) if tree is None else proofs(tree)
