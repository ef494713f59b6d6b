"""Mixing sources to target weights by pivotal dependent rounding.

A source's target in words gives each of its documents the same expected number of copies, target / source size. The
whole part is taken outright; the fraction is a probability that must become 0 or 1. Documents are paired, and mass is
moved at random between the two so that each probability keeps its expectation and the sum of probability x size does
not change, until one of the two is 0 or 1; the other meets the next document. Blocks of documents of one source run
apart and leave at most one open document each; open documents meet in the blocks of the next level, a reduction tree
of ``fan`` children, and the last one of a source is drawn. So a source's taken words differ from its target by less
than one document.

Blocks come from a hash of id and text, and every draw from a generator seeded by source, level and block: reruns agree.
The hot source is many blocks. A null source is a source of its own, last in order. Null and empty texts have size 0 and
are never taken. Repeated rows are mixed as rows of their own. Without any words all targets are 0.
"""

import random

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotejo.llm.common import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 1024
FAN = 64
_SPACES = " \t\n\x0b\x0c\r"
_TINY = 1e-9


def sized(documents: DataFrame, columns, text="text", source="source", doc_id="doc_id") -> DataFrame:
    """The columns as struct ``row``, and source, size (words) and a content hash of every document."""
    bare = F.btrim(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(_SPACES))
    size = F.when(F.length(bare) > 0, F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("long")
    row = F.struct(*[documents[c] for c in columns]).alias("row")
    return documents.select(row, F.col(source).cast("string").alias("source"), size.alias("size"), F.xxhash64(doc_id, text).alias("hash"))


def targets(rows: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """source, source_size, n, target. Sources share ``share`` of all words by weight; none goes above ``most`` times its
    size, and what it leaves is shared again. One row per source, sorted twice."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # sources reach their caps in the order of cap / weight; the level is set by the first that does not
    full = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.withColumn("level", (share * F.sum("source_size").over(everything) - before) / left)
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return totals.select("source", "source_size", "n", target.alias("target"))


def mixed(rows: DataFrame, goals: DataFrame, seed=17, block_rows=BLOCK_ROWS, fan=FAN) -> DataFrame:
    """row, source, size, source_size, target, copies of every sized document."""
    key = lambda c: F.struct(c.isNull().alias("none"), F.coalesce(c, F.lit("")).alias("name"))
    goals = goals.withColumn("key", key(F.col("source"))).drop("source")
    open_ = rows.withColumn("key", key(F.col("source"))).join(goals, "key").drop("key")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(expected + _TINY)
    part = F.when(F.col("size") > 0, F.greatest(expected - whole, F.lit(0.0))).otherwise(0.0)
    blocks = F.ceil(F.col("n") / block_rows)
    open_ = open_.select(
        "row", "source", "size", "hash", "source_size", "target", F.when(F.col("size") > 0, whole).otherwise(0).cast("long").alias("copies"), part.alias("part"),
        F.pmod(F.xxhash64("hash", F.lit(seed)), blocks).alias("block"), blocks.alias("blocks"),
    )
    most = int(goals.agg(F.max(F.ceil(F.col("n") / block_rows))).first()[0] or 1)
    done, level = None, 0
    while True:
        solved = stored(open_.groupBy("source", "block").applyInArrow(_pivot(seed, level), open_.schema))
        decided = solved.filter("part = 0")
        done = decided if done is None else done.unionByName(decided)
        if most == 1:  # every source has met in one block
            return done.select("row", "source", "size", "source_size", "target", "copies")
        open_ = solved.filter("part > 0").withColumns(
            {"block": F.floor(F.col("block") / fan), "blocks": F.ceil(F.col("blocks") / fan)}
        )
        most, level = -(-most // fan), level + 1


def _pivot(seed, level):
    def solve(key, table):
        source, block = (k.as_py() for k in key)
        draw = random.Random(f"{seed}|{source}|{source is None}|{level}|{block}").random
        part, size, tie = (table[c].to_pylist() for c in ("part", "size", "hash"))
        held = None
        for k in sorted(range(len(part)), key=lambda k: (-size[k], tie[k])):  # large first: the one left open is small
            if _settle(part, k):
                continue
            if held is None:
                held = k
                continue
            meet(part, size, held, k, draw())
            settled = _settle(part, held)
            if not _settle(part, k):
                held = k
            elif settled:
                held = None
        if held is not None and table["blocks"][0].as_py() == 1:
            part[held] = 1.0 if draw() < part[held] else 0.0
        copies = [c + int(p == 1.0) for c, p in zip(table["copies"].to_pylist(), part)]
        table = table.set_column(table.column_names.index("copies"), "copies", pa.array(copies, pa.int64()))
        return table.set_column(table.column_names.index("part"), "part", pa.array([p % 1.0 for p in part], pa.float64()))

    return solve


def _settle(part, k):
    if part[k] < _TINY or part[k] > 1 - _TINY:
        part[k] = float(round(part[k]))
    return part[k] in (0.0, 1.0)


def meet(part, size, i, j, chance):
    """Move mass between two open documents: the sum of part x size stays, each part keeps its expectation."""
    ratio = size[i] / size[j]
    up = min(1 - part[i], part[j] / ratio)
    down = min(part[i], (1 - part[j]) / ratio)
    step = up if chance * (up + down) < down else -down
    part[i] += step
    part[j] -= step * ratio
