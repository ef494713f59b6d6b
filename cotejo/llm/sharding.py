"""Shards of near equal bytes by longest-processing-time scheduling: rows of one text stay together.

Groups of equal texts, the largest first, each go to the shard with the least load, which a heap gives. The order is
total: size (largest first), then the text's digest; equal loads go to the lower shard. A group larger than its
share leaves the others to the remaining shards.

At scale the heap never sees more than ``most`` items. While there are more, they are bundled: items are dealt to
blocks of ``block`` items by hash, and in each block the same scheduling makes bundles of near equal size out of them (an item
larger than that is a bundle alone). A round leaves a sixteenth of the items, the last one ``most``, which are put on the
shards in one task. Up to ``most`` groups the result is that of one heap over all groups; beyond, shards still differ by no
more than about a bundle.

A group is known by the MD5 digest of its text (a collision would only keep two texts together). The texts are read
once. Rows meet their group's shard by a shuffle on the digest; the few groups that hold more than 1 / ``most`` of the
rows, ``most`` at the very most, are broadcast instead, so no group of copies fills a task. The slot is a rank in a
global order (``ranked``).

Null and empty texts form one group, of size 1 a row. Null and repeated ids and rows count like others; rows that
agree in id and text are interchangeable. An empty table gives no rows. A kept column named like a result gives way.
"""

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import picked, stored
from cotejo.llm.ranks import ranked

SHARDS = 16
MOST = 1 << 14
BLOCK = 1 << 12
PER_BUNDLE = 16


def scheduled(sizes, machines):
    """The machine of every item, by longest processing time; items come largest first."""
    heap = [(0, m) for m in range(machines)]
    out = []
    for size in sizes:
        load, machine = heap[0]
        out.append(machine)
        heapq.heapreplace(heap, (load + size, machine))
    return out


def _dealt(items: DataFrame, block, machines) -> DataFrame:
    """item, size, block -> item, block, machine, by one heap a block."""

    def deal(table):
        table = table.sort_by([("size", "descending"), ("item", "ascending")])
        to = scheduled(table.column("size").to_pylist(), machines)
        return pa.table([table.column("item"), table.column("block"), pa.array(to, pa.int32()), table.column("size")], names=["item", "block", "machine", "size"])

    return items.withColumn("block", block).groupBy("block").applyInArrow(deal, "item string, block long, machine int, size long")


def assigned(groups: DataFrame, shards=SHARDS, most=MOST, block=BLOCK) -> DataFrame:
    """item string (unique), shard int for the items of ``groups`` (item, size long)."""
    rounds, items, n = [], groups, groups.count()
    while n > most:
        blocks = -(-n // block)
        machines = max(1, block // PER_BUNDLE, most // blocks)
        # a hash of its own in each round, so that bundles of one block part again
        deal = F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(blocks))
        bundle = F.concat_ws(":", F.lit(len(rounds)), "block", "machine")
        dealt = stored(_dealt(items, deal, machines).select("item", bundle.alias("bundle"), "size"))
        rounds.append(dealt.select("item", "bundle"))
        items = stored(dealt.groupBy("bundle").agg(F.sum("size").alias("size")).withColumnRenamed("bundle", "item"))
        n = items.count()
    placed = _dealt(items, F.lit(0).cast("long"), shards).select("item", F.col("machine").alias("shard"))
    for dealt in reversed(rounds):
        up = placed.select(F.col("item").alias("bundle"), "shard")
        placed = dealt.join(up, "bundle").select("item", "shard")
    return placed


def sharded(docs: DataFrame, shards=SHARDS, identity="doc_id", text="text", keep=None, most=MOST, block=BLOCK) -> DataFrame:
    """Kept columns, size (UTF-8 bytes + 1), text_crc32, shard and slot (0, 1, 2 … in its shard, by id)."""
    kept = picked(docs, keep, [(n, "") for n in ("size", "text_crc32", "shard", "slot")])
    whole = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    rows = stored(docs.select(
        F.struct(F.lit(True).alias("any_"), *[docs[c] for c in kept]).alias("kept_"), docs[identity].alias("id_"),
        (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"), F.md5(whole).alias("item"),
    ))
    groups = stored(rows.groupBy("item").agg(F.sum("size").alias("size"), F.count("*").alias("rows_")))
    shard = stored(assigned(groups.select("item", "size"), shards, most, block).join(groups.select("item", "rows_"), "item"))
    hot = F.col("rows_") * most > F.lit(rows.count())
    some = shard.where(hot).select("item", F.col("shard").alias("hot_"))
    rest = shard.where(~hot).select("item", "shard")
    found = rows.join(F.broadcast(some), "item", "left")
    known = found.where("hot_ IS NOT NULL").withColumnRenamed("hot_", "shard")
    others = found.where("hot_ IS NULL").drop("hot_").join(rest, "item")
    placed = ranked(known.unionByName(others), ["shard"], ["id_", "item"])
    return placed.select(*[F.col("kept_")[c].alias(c) for c in kept], "size", "text_crc32", "shard", F.col("rank").alias("slot"))
