"""Merkle dataset manifest: one ternary hash tree per group of rows, stored in van Emde Boas order, with proofs.

Leaves of a group stand in the order of their id. Every three consecutive nodes (the last run may hold fewer, even one)
give the SHA-256 of their hexadecimal digests put together, until one node, the group's root, remains; the groups' roots
in turn, in the order of the group's value, give the root of the dataset.

A tree is cut into aligned subtrees (blocks) of 3^7 leaves. A block keeps its digests in one array in van Emde Boas
order: the levels are split at half height, the upper subtree comes first, the lower ones follow, and each of them is
laid out the same way, so a path from a leaf to the block's root touches few stretches of memory whatever a cache line
or page holds. Where a node lies is computed (``Layout.address``) and never stored; building and fetching siblings use
the same arithmetic. The roots of the blocks are the leaves of the next round of blocks: 3^7 times fewer.

Spark deals leaves to blocks and blocks to tasks; a task holds some blocks at a time. A group of any share of the rows
is just many blocks. Proofs go the other way: the path of a block's root is joined to the block (one row per block),
which appends it to the path of each of its leaves.

Nulls: every hashed column may be null and hashes as ``-``. A null group value is the first group, null ids come first
in their group; rows of one id stand in the order of their leaf's digest, and equal rows are interchangeable. Texts of
any length are hashed whole where they are read and go no further. An empty table gives no rows. Columns are taken by
name, so others of any name do not matter; only those in ``keep`` come back.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import stored
from cotejo.llm.ranks import ranked

FAN = 3
HEIGHT = 7
DIGEST = 32


def leaf_digest(columns):
    """SHA-256 (hexadecimal) of the columns in order: ``-`` for null, else the byte length, a colon and the value."""
    texts = [F.coalesce(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def size_of(levels):
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


class Layout:
    """Addresses in a full ternary tree of ``levels`` levels of nodes, in van Emde Boas order."""

    def __init__(self, levels):
        self.levels = levels
        self.size = size_of(levels)

    def address(self, depth, index):
        """The place of node ``index`` of level ``depth`` (0 is the root); ``index`` may be an array."""
        index = np.asarray(index, np.int64)
        base, levels = np.zeros_like(index), self.levels
        while levels > 1:
            upper = levels // 2
            if depth < upper:
                levels = upper
                continue
            depth, lower = depth - upper, levels - upper
            below = FAN**depth
            base += size_of(upper) + (index // below) * size_of(lower)
            index, levels = index % below, lower
        return base


def parent_digest(children):
    """The digest of a run: SHA-256 over the hexadecimal digests of its nodes."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def levels_for(items, total, height):
    """Node levels of a block: as high as its tree needs, ``height`` + 1 at most."""
    most, levels = 1, 1
    while levels <= height and most < total:
        most, levels = most * FAN, levels + 1
    return levels


def built(leaves, levels) -> bytes:
    """A block's digests (32 bytes each) in van Emde Boas order; places of missing nodes are zero."""
    layout = Layout(levels)
    nodes = np.zeros((layout.size, DIGEST), np.uint8)
    nodes[layout.address(levels - 1, np.arange(len(leaves)))] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
    count = len(leaves)
    for depth in range(levels - 2, -1, -1):
        below, count = count, -(-count // FAN)
        text = nodes[layout.address(depth + 1, np.arange(below))].tobytes().hex()
        run = FAN * 2 * DIGEST
        parents = b"".join(hashlib.sha256(text[run * i:run * (i + 1)].encode()).digest() for i in range(count))
        nodes[layout.address(depth, np.arange(count))] = np.frombuffer(parents, np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


class Block:
    """Reads a stored block: its root, its leaves, and the siblings on the way up."""

    def __init__(self, data, count, levels):
        self.layout, self.count = Layout(levels), count
        self.nodes = np.frombuffer(data, np.uint8).reshape(-1, DIGEST)
        self.sides = [self._sides(t) for t in range(levels - 1)]

    def _sides(self, up):
        """Per node ``up`` levels above the leaves: (digests left of it in its run, digests right of it)."""
        n = -(-self.count // FAN**up)
        text = self.nodes[self.layout.address(self.layout.levels - 1 - up, np.arange(n))].tobytes().hex()
        w, out = 2 * DIGEST, []
        for i in range(n):
            low, high = i - i % FAN, min(n, i - i % FAN + FAN)
            out.append((text[w * low:w * i], text[w * (i + 1):w * high]))
        return out

    @property
    def root(self):
        return self.nodes[0].tobytes().hex()

    def leaf(self, i):
        return self.nodes[self.layout.address(self.layout.levels - 1, i)].tobytes().hex()

    def path(self, i):
        """[left, right, left, right, …]: the siblings' digests on both sides, level by level up to the block's root."""
        out = []
        for sides in self.sides:
            out += sides[i]
            i //= FAN
        return out


def folded(digest, path):
    """The root that a leaf and the siblings of its path give."""
    for left, right in zip(path[::2], path[1::2]):
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


@dataclass(frozen=True)
class Forest:
    """Blocks of many trees: ``rounds[0]`` holds the leaves, the last round one block per tree (tree, block, nodes …)."""

    rounds: list
    height: int

    def roots(self) -> DataFrame:
        """tree, root (binary): the top block's node at address 0."""
        return self.rounds[-1].select("tree", F.substring("nodes", 1, DIGEST).alias("root"))


_KEPT = "array<struct<kept:{kept},other:binary>>"


def plant(items: DataFrame, height=HEIGHT) -> Forest:
    """Trees over ``items``: tree long, rank long, total long, node binary, kept struct, other binary.

    ``rank`` 0, 1, 2 … is a leaf's place in its tree of ``total`` leaves; ``kept`` and ``other`` (a second digest, may be
    null) travel with the leaf.
    """
    wide, rounds = FAN**height, []
    most = items.agg(F.max("total")).first()[0] or 0
    while True:
        kind = items.schema["kept"].dataType.simpleString()
        schema = f"tree long, block long, total long, count long, levels int, nodes binary, leaves {_KEPT.format(kept=kind)}"

        def build(key, table):
            table = table.sort_by("rank")
            total = table.column("total")[0].as_py()
            levels = levels_for(table.num_rows, total, height)
            nodes = built(table.column("node").to_pylist(), levels)
            kept = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in ("kept", "other")], ["kept", "other"])
            leaves = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
            head = [[table.column("tree")[0].as_py()], [key[1].as_py()], [total], [table.num_rows], pa.array([levels], pa.int32()), [nodes]]
            return pa.Table.from_arrays([pa.array(x) if isinstance(x, list) else x for x in head] + [leaves], names=["tree", "block", "total", "count", "levels", "nodes", "leaves"])

        blocks = stored(items.withColumn("block", F.floor(F.col("rank") / wide).cast("long")).groupBy("tree", "block").applyInArrow(build, schema))
        rounds.append(blocks)
        if most <= wide:
            return Forest(rounds, height)
        most = -(-most // wide)
        items = blocks.select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("total") / wide).cast("long").alias("total"),
            F.substring("nodes", 1, DIGEST).alias("node"), F.struct(F.lit(None).cast("boolean").alias("inner")).alias("kept"), F.lit(None).cast("binary").alias("other"),
        )


def descend(forest: Forest, start: DataFrame, last) -> DataFrame:
    """Walk from the trees' roots to their leaves. ``start``: tree, path array<string>, and ``crown`` array<string>
    (digests that stay with every row). ``last(blocks)`` turns the leaf round, joined with its paths, into rows.
    """
    paths = start.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(forest.rounds[1:]):
        joined = blocks.join(paths, ["tree", "block"])
        paths = joined.select("tree", "block", "count", "levels", "nodes", "path", "crown").mapInArrow(
            _below(forest.height), "tree long, block long, path array<string>, crown array<string>"
        )
    return last(forest.rounds[0].join(paths, ["tree", "block"]))


def _below(height):
    """Paths of the leaves of inner blocks; the leaf at place ``rank`` is the root of block ``rank`` of the next round."""
    wide = FAN**height

    def batches(frames):
        for frame in frames:
            for row in frame.to_pylist():
                block = Block(row["nodes"], row["count"], row["levels"])
                n = row["count"]
                paths = [block.path(i) + row["path"] for i in range(n)]
                ranks = [row["block"] * wide + i for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.int64()), pa.array(ranks, pa.int64()), pa.array(paths, pa.list_(pa.string())), pa.array([row["crown"]] * n, pa.list_(pa.string()))],
                    names=["tree", "block", "path", "crown"],
                )

    return batches


def _leaf_rows(kind, compute, fields):
    """mapInArrow over leaf blocks: kept columns plus what ``compute(block, i, other, path, crown)`` returns."""

    def batches(frames):
        for frame in frames:
            for at in range(frame.num_rows):
                row = {c: frame.column(c)[at].as_py() for c in ("count", "levels", "nodes", "path", "crown")}
                leaves = frame.column("leaves")[at].values
                block, others = Block(row["nodes"], row["count"], row["levels"]), leaves.field("other").to_pylist()
                out = list(zip(*[compute(block, i, others[i], row["path"], row["crown"]) for i in range(row["count"])]))
                yield pa.RecordBatch.from_arrays([leaves.field("kept"), *[pa.array(list(c)) for c in out]], names=["kept", *fields])

    def rows(blocks):
        schema = f"kept {kind}, " + ", ".join(f"{n} {t}" for n, t in fields.items())
        return blocks.select("count", "levels", "nodes", "leaves", "path", "crown").mapInArrow(batches, schema)

    return rows


@dataclass(frozen=True)
class Manifest:
    """The stored trees of a dataset: one per group, and the one over the groups' roots."""

    groups: Forest
    top: Forest
    kind: str  # type of the leaves' kept struct

    def crowned(self) -> DataFrame:
        """Per group: tree, group (its value), path (of its root), crown ([subroot, root])."""
        start = self.top.rounds[-1].select("tree", F.array().cast("array<string>").alias("path"), F.array(F.lower(F.hex(F.substring("nodes", 1, DIGEST)))).alias("crown"))

        def crowns(block, i, other, path, crown):
            return block.path(i) + path, [block.leaf(i), *crown]

        kind = dict(self.top.rounds[0].dtypes)["leaves"]
        kind = kind[len("array<struct<kept:"):-len(",other:binary>>")]
        out = descend(self.top, start, _leaf_rows(kind, crowns, {"path": "array<string>", "crown": "array<string>"}))
        return out.select(F.col("kept.tree").alias("tree"), F.col("kept.group").alias("group"), "path", "crown")

    def proofs(self) -> DataFrame:
        """kept, leaf, subroot, root, proof (the siblings' digests from the leaf up), folded_root, verified.

        ``folded_root`` comes from the presented leaf and the stored siblings; ``verified`` says whether it is the root.
        """
        fields = {"leaf": "string", "subroot": "string", "root": "string", "proof": "array<string>", "folded_root": "string", "verified": "boolean"}

        def proved(block, i, other, path, crown):
            whole, leaf = block.path(i) + path, block.leaf(i)
            digests = [d[k:k + 2 * DIGEST] for d in whole for k in range(0, len(d), 2 * DIGEST)]
            fold = folded(other.hex() if other is not None else leaf, whole)
            return leaf, crown[0], crown[1], digests, fold, fold == crown[1]

        return descend(self.groups, self.crowned().select("tree", "path", "crown"), _leaf_rows(self.kind, proved, fields))


def manifest(docs: DataFrame, columns, group, order, keep, presented=None, height=HEIGHT) -> Manifest:
    """The trees over ``docs``. ``presented`` maps columns to what is shown in their place when proofs are checked."""
    shown = {c: (presented or {}).get(c, docs[c]) for c in columns}
    leaves = stored(docs.select(
        docs[group].alias("group"), docs[order].alias("order"), F.struct(*[docs[c].alias(c) for c in keep]).alias("kept"),
        F.unhex(leaf_digest([docs[c] for c in columns])).alias("node"), F.unhex(leaf_digest(list(shown.values()))).alias("other"),
    ))
    kind = leaves.schema["kept"].dataType.simpleString()
    trees = stored(ranked(leaves.groupBy("group").count().drop("count"), [], ["group"]).withColumnRenamed("rank", "tree"))
    placed = ranked(leaves, ["group"], ["order", "node"])
    named = trees.select(F.col("group").alias("group_"), "tree")
    items = placed.join(named, F.col("group").eqNullSafe(F.col("group_"))).select("tree", "rank", "total", "node", "kept", "other")
    groups = plant(stored(items), height)
    roots = groups.roots().join(trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "total", F.col("root").alias("node"),
        F.struct("tree", "group").alias("kept"), F.lit(None).cast("binary").alias("other"),
    )
    return Manifest(groups, plant(stored(roots), height), kind)
