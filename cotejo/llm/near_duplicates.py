"""MinHash near-duplicates with HyperMinHash registers.

Per document one hash of each distinct word shingle fills one of ``BANDS * ROWS`` buckets; a bucket keeps its smallest
value as a compressed register: the leading-zero count and ``MANTISSA`` bits behind it, 16 bits in all. Empty buckets
borrow from filled ones by a fixed probing order. Bands of ``ROWS`` registers are the candidate keys: a pair at the
threshold 0.8 misses all 48 bands with probability 5e-7, and one above it less.

Documents with equal shingle sets collapse first (128-bit set hash), so copies are never paired. In a bucket every set is
compared with the bucket's centre only. Sets that are not linked to their centre then meet the other sets of that centre
in blocks of ``BLOCK`` by ``BLOCK``, from which only links leave: of a block's pairs those are looked at that the
triangle inequality of the Jaccard distance leaves open, that are not in one component already, that sizes allow, and
whose registers' estimate, corrected for register collisions, is not six deviations below the threshold. Every pair is confirmed on
full shingle sets. So no bucket is expanded into rows of pairs. A link between candidates is lost only where a register
estimate errs by six deviations (some 1e-9 of the pairs at the threshold). Components come from star contraction over the
confirmed links, in frames stored per round.

A centre may hold a third of all sets. Joins on the centre first set apart the ``HEAVY`` or fewer centres that hold more
than one ``HEAVY``-th of the rows and broadcast one small row for each; a centre's text is repeated once for every
``BLOCK`` of its sets, which are dealt among the copies. Blocks and groups of blocks are bounded by sets and by shingles.

A shingle is ``size`` consecutive words, A-Z lower-cased; a text of fewer words is one shingle of them all. Documents
without words or text have no shingles, link with nothing and are kept. Rows that share an id, null ids among them, and
repeated rows are judged by their texts; a component's id is its smallest non-null id.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import Words, chain, cuts, map_texts, mix, stored

BANDS, ROWS = 48, 6
BUCKETS = BANDS * ROWS
MANTISSA = 10
THRESHOLD = 0.8
SHINGLE = 5
BLOCK = 1024
BLOCK_SHINGLES = BLOCK * 1024
HEAVY = 1000
_LENDERS = 4096


def shingle_sets(texts, size):
    """(document, hash) of the distinct shingles, ordered by document, then hash."""
    w = Words(texts, alnum=False)
    words, doc = w.hashes(), w.doc()
    full = np.flatnonzero(np.arange(len(words)) + size <= w.first[1:][doc]) if len(words) else np.zeros(0, np.int64)
    shingles = chain([words[full + k] for k in range(size)])
    owner = doc[full]
    few = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(few):
        rest = np.full(len(few), 0x2545F4914F6CDD1D, np.uint64)
        for k in range(size - 1):
            on = w.counts[few] > k
            rest[on] = chain([rest[on], words[w.first[few[on]] + k]])
        shingles, owner = np.append(shingles, rest), np.append(owner, few)
    order = np.argsort(shingles, kind="stable")
    order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
    shingles, owner = shingles[order], owner[order]
    new = np.append(True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1]))[:len(shingles)]
    return owner[new], shingles[new]


@functools.cache
def _probing():
    """For each bucket the order in which it asks others for a register."""
    at = np.arange(BUCKETS, dtype=np.uint64)[None, :] + np.arange(_LENDERS, dtype=np.uint64)[:, None] * np.uint64(BUCKETS)
    return (mix(at + np.uint64(1 << 40)) % np.uint64(BUCKETS)).astype(np.int64)


def registers(owner, shingles, count):
    """HyperMinHash registers (count x BUCKETS, 16 bits) of documents given as ordered (owner, shingle) pairs."""
    value = mix(shingles ^ np.uint64(0x7F4A7C159E3779B9))
    slot = owner * BUCKETS + (mix(shingles + np.uint64(0x632BE59BD9B4E019)) % np.uint64(BUCKETS)).astype(np.int64)
    least = np.full(count * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, slot, value)
    filled = np.zeros(count * BUCKETS, bool)
    filled[slot] = True
    filled, out = filled.reshape(count, BUCKETS), compressed(least).reshape(count, BUCKETS)
    out, given = out.copy(), out
    probes = _probing()
    open_rows, open_slots = np.nonzero(~filled & filled.any(1)[:, None])
    for step in range(_LENDERS):
        if not len(open_rows):
            break
        source = probes[step, open_slots]
        good = filled[open_rows, source]
        out[open_rows[good], open_slots[good]] = given[open_rows[good], source[good]]
        open_rows, open_slots = open_rows[~good], open_slots[~good]
    for row, s in zip(open_rows, open_slots):
        out[row, s] = given[row, np.flatnonzero(filled[row])[0]]
    return out


def compressed(value):
    """Leading-zero count (6 bits) and the MANTISSA bits behind the first one."""
    zeros = np.zeros(len(value), np.uint64)
    rest = value.copy()
    for width in (32, 16, 8, 4, 2, 1):
        high = rest < np.uint64(1 << (64 - width))
        zeros[high] += np.uint64(width)
        rest[high] <<= np.uint64(width)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def estimate(a, b):
    """Jaccard estimate of register rows: the share of equal registers, less what different minima agree on by chance."""
    chance = 2.0**-MANTISSA / 3  # equal zero counts: sum of 1/4^k = 1/3; equal mantissas: 2^-MANTISSA
    return np.maximum(((a == b).mean(1) - chance) / (1 - chance), 0)


def sketches(documents: DataFrame, size=SHINGLE, text="text", keep=None) -> DataFrame:
    """Kept columns plus n_shingles, set_high, set_low (hash of the set) and registers (little-endian 16-bit)."""

    def sketch(texts):
        owner, shingles = shingle_sets(texts, size)
        regs = registers(owner, shingles, len(texts))
        counts, high, low = set_hash(owner, shingles, len(texts))
        width = BUCKETS * 2
        regs = pa.Array.from_buffers(pa.binary(width), len(texts), [None, pa.py_buffer(regs.astype("<u2").tobytes())]).cast(pa.binary())
        return [pa.array(counts, pa.int64()), pa.array(high), pa.array(low), regs]

    fields = [("n_shingles", "long"), ("set_high", "long"), ("set_low", "long"), ("registers", "binary")]
    return map_texts(documents, sketch, fields, text, keep)


def set_hash(owner, shingles, count):
    first = np.searchsorted(owner, np.arange(count + 1))
    parts = []
    for salt in (0x1B873593CC9E2D51, 0x38B34AE5A1E38B93):
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(salt))))
        parts.append((sums[first[1:]] - sums[first[:-1]]).astype(np.int64))
    return np.diff(first), *parts


def _band_keys(frames):
    for frame in frames:
        regs = np.frombuffer(b"".join(frame.column(1).to_pylist()), "<u2").reshape(-1, BANDS, ROWS).astype(np.uint64)
        band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), regs.shape[:2])
        keys = chain([band, *(regs[:, :, k] for k in range(ROWS))]).astype(np.int64)
        node = np.repeat(frame.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])


_SET = ["set_high", "set_low", "n_shingles"]


def classified(documents: DataFrame, size=SHINGLE, threshold=THRESHOLD, doc_id="doc_id", text="text", keep=None) -> DataFrame:
    """Kept columns plus n_shingles, component_id and kept (the row has its component's id)."""
    taken = {"n_shingles", "component_id", "kept"}
    names = [c for c in (documents.columns if keep is None else keep) if c.lower() not in taken]
    rows, label = _labelled(documents, names, size, threshold, doc_id, text)
    label = label.select(*_SET, "component_id", F.lit(True).alias("known_"))
    component = F.when(F.col("known_"), F.col("component_id")).otherwise(F.col("id_"))
    out = rows.drop("registers").join(label, _SET, "left").select("row_", "n_shingles", "id_", component.alias("component_id"))
    return out.select(*[F.col("row_")[c].alias(c) for c in names], "n_shingles", "component_id", F.col("id_").eqNullSafe(F.col("component_id")).alias("kept"))


def first_of_each(documents: DataFrame, size=SHINGLE, threshold=THRESHOLD, doc_id="doc_id", text="text") -> DataFrame:
    """One document of each component, the one with its id, with its own columns; documents without words stay."""
    rows, label = _labelled(documents, documents.columns, size, threshold, doc_id, text)
    # one set per component holds the id; the id in the join key spreads the copies of a set
    best = label.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("part").agg(F.min("node").alias("node"))
    best = label.join(best, ["part", "node"]).select(*_SET, F.col("id").alias("id_"))
    same = [rows[c] == best[c] for c in _SET] + [rows["id_"].eqNullSafe(best["id_"])]
    some = rows.join(best, same).select(*[rows[c] for c in (*_SET, "id_", "row_")])
    some = some.groupBy(*_SET, "id_").agg(F.any_value("row_").alias("row_")).select("row_")
    return some.unionByName(rows.filter("n_shingles = 0").select("row_")).select("row_.*")


def _labelled(documents, names, size, threshold, doc_id, text):
    """(rows with their set, sets with their node and component)."""
    packed = documents.select(F.struct(*[documents[c] for c in names]).alias("row_"), F.col(doc_id).alias("id_"), F.col(text).cast("string").alias("text_"))
    packed = packed.withColumn("hash_", F.xxhash64("text_"))
    rows = stored(sketches(packed, size, "text_", ["row_", "id_", "hash_"]))
    nodes, links = linked(rows, packed, size, threshold)
    label = nodes.drop("registers").join(components(links), "node", "left").withColumn("part", F.coalesce("part", "node"))
    return rows, label.join(label.groupBy("part").agg(F.min("id").alias("component_id")), "part")


def linked(rows: DataFrame, packed: DataFrame, size, threshold):
    """(nodes: one per distinct non-empty set, links: confirmed pairs of nodes)."""
    place = F.struct(F.col("id_").isNull().alias("no_id"), "id_", "hash_")  # one of the set's texts, of the smallest id
    sets = rows.filter("n_shingles > 0").groupBy(*_SET).agg(F.min(place).alias("place"), F.any_value("registers").alias("registers"))
    sets = sets.select(*_SET, F.col("place.id_").alias("id"), F.col("place.hash_").alias("hash"), "registers")
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()))
    bands = nodes.select("node", "registers").mapInArrow(_band_keys, "key long, node long")
    centres = bands.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n_")).filter("n_ > 1").drop("n_")
    spokes = stored(bands.join(centres, "key").filter("node <> centre").select("centre", "node").distinct())
    texts = texts_of(spokes.select(F.explode(F.array("centre", "node")).alias("node")).distinct(), nodes, packed, size)
    n_spokes = stored(spokes.groupBy("centre").agg(F.count("*").alias("n_")))
    copies = F.ceil(F.col("n_") / BLOCK)
    dealt = met_at_centre(spokes, n_spokes, "n_").select(F.col("centre").alias("a"), F.col("node").alias("b"), F.pmod(F.xxhash64("node"), copies).alias("salt"))
    of_a = texts.toDF("a", "text_a").join(n_spokes.withColumnRenamed("centre", "a"), "a").select("a", "text_a", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("salt"))
    both = dealt.join(texts.toDF("b", "text_b"), "b").join(of_a, ["a", "salt"])
    first = both.select("a", "b", "text_a", "text_b").mapInArrow(_overlaps(size), "a long, b long, both long, either long")
    good = F.col("both") * 100 >= F.lit(round(threshold * 100)) * F.col("either")
    first = stored(first.select(F.col("a").alias("centre"), F.col("b").alias("node"), (1 - F.col("both") / F.col("either")).alias("d"), good.alias("in_")))
    links = first.filter("in_").select(F.col("centre").alias("a"), F.col("node").alias("b"))

    # sets that are open at a centre, and those that may be near one of them: distances to the centre differ by at most 1 - threshold
    far = 1 - threshold + 1e-9
    open_ = F.when(~F.col("in_"), F.col("d"))
    facts = stored(first.groupBy("centre").agg(F.min(open_).alias("least"), F.count("*").alias("n_all")).filter("least IS NOT NULL"))
    ring = met_at_centre(first, facts, "n_all").filter(F.col("d") >= F.col("least") - far).select("centre", "node", "d", "in_")
    ring = ring.join(nodes.select("node", F.col("n_shingles").alias("weight")), "node").join(components(links), "node", "left")
    ring = stored(ring.withColumn("part", F.coalesce("part", "node")))
    of_open = [F.sum(F.when(~F.col("in_"), c).otherwise(0)) for c in (F.lit(1), F.col("weight"))]
    counts = ring.groupBy("centre").agg(F.count("*").alias("n_ring"), F.sum("weight").alias("w_ring"), of_open[0].alias("n_open"), of_open[1].alias("w_open"))
    ring = met_at_centre(ring, stored(counts), "n_ring").filter("n_ring > 1")
    across, down = (F.ceil(F.greatest(F.col("n_" + c) / BLOCK, F.col("w_" + c) / BLOCK_SHINGLES)) for c in ("ring", "open"))
    sides = [F.struct(F.lit(False).alias("open"), F.pmod(F.xxhash64("node"), across).alias("x"), F.sequence(F.lit(0).cast("long"), down - 1).alias("ys"))]
    sides.append(F.struct(F.lit(True).alias("open"), F.pmod(F.xxhash64("node"), down).alias("y"), F.sequence(F.lit(0).cast("long"), across - 1).alias("xs")))
    base = ["centre", "node", "d", "part", "weight"]
    as_x = ring.withColumn("s", sides[0]).select(*base, "s.open", "s.x", F.explode("s.ys").alias("y"))
    as_y = ring.filter("NOT in_").withColumn("s", sides[1]).select(*base, "s.open", F.explode("s.xs").alias("x"), "s.y")
    blocks = stored(as_x.unionByName(as_y))
    n, weight = blocks.agg(F.count("*"), F.sum("weight")).first()
    groups = 1 + max(n // (2 * BLOCK), (weight or 0) // (2 * BLOCK_SHINGLES))
    blocks = blocks.drop("weight").withColumn("group", F.pmod(F.xxhash64("centre", "x", "y"), F.lit(groups)))
    blocks = blocks.join(texts, "node").join(nodes.select("node", "registers", "n_shingles"), "node")
    more = blocks.groupBy("group").applyInArrow(_near_in_blocks(size, threshold), "a long, b long")
    return nodes, stored(links.unionByName(more))


def met_at_centre(rows: DataFrame, small: DataFrame, count) -> DataFrame:
    """Rows joined to the one row of ``small`` (stored) of their centre. ``count`` is that centre's number of rows: at most
    ``HEAVY`` centres hold more than one ``HEAVY``-th of all, and their rows of ``small`` are broadcast; no other is hot."""
    heavy = F.col(count) > (small.agg(F.sum(count)).first()[0] or 0) / HEAVY
    few = F.broadcast(small.filter(heavy))
    rest = rows.join(F.broadcast(few.select("centre")), "centre", "left_anti").join(small.filter(~heavy), "centre")
    return rows.join(few, "centre").unionByName(rest)


def texts_of(wanted: DataFrame, nodes: DataFrame, packed: DataFrame, size) -> DataFrame:
    """node, text: one whole text of each wanted node."""
    wanted = wanted.join(nodes.drop("registers"), "node")
    # null and repeated ids are told apart by their texts' hashes
    found = wanted.join(packed.select("id_", "hash_", "text_"), F.col("id").eqNullSafe(F.col("id_")) & (F.col("hash") == F.col("hash_")))

    def same_set(texts):  # equal hashes of different texts: only the one with the node's set counts
        counts, high, low = set_hash(*shingle_sets(texts, size), len(texts))
        return [pa.array(counts, pa.int64()), pa.array(high), pa.array(low)]

    found = map_texts(found, same_set, [("n_", "long"), ("high_", "long"), ("low_", "long")], "text_", ["node", "n_shingles", "set_high", "set_low", "text_"])
    found = found.filter("n_ = n_shingles AND high_ = set_high AND low_ = set_low")
    return stored(found.groupBy("node").agg(F.any_value("text_").alias("text")))


def _near_in_blocks(size, threshold):
    """Links between the open sets and the other sets of a block: sizes and distances to the centre must allow one, then the
    registers' estimate, then the full sets decide."""
    percent = round(threshold * 100)

    def solve(key, table):
        table = table.combine_chunks()
        column = {c: table[c].to_numpy() for c in ("centre", "x", "y", "node", "d", "part", "n_shingles")}
        open_ = np.array(table["open"].to_pylist(), bool)
        regs = np.frombuffer(b"".join(table["registers"].to_pylist()), "<u2").reshape(-1, BUCKETS)
        texts = pa.array(table["text"].to_pylist(), pa.large_string())
        owner, shingles = shingle_sets(texts, size)
        _, codes = np.unique(shingles, return_inverse=True)
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        order = np.lexsort((column["y"], column["x"], column["centre"]))
        same = np.stack([column[c][order] for c in ("centre", "x", "y")])
        cut = np.flatnonzero(np.append(True, (same[:, 1:] != same[:, :-1]).any(0)))
        a, b, seen = [], [], np.zeros(int(codes.max()) + 1, bool)
        for low, high in zip(cut, np.append(cut[1:], len(order))):
            rows = order[low:high]
            xs, ys = rows[~open_[rows]], rows[open_[rows]]
            for y in ys:
                n, few = column["n_shingles"][xs], column["n_shingles"][y]
                fits = (column["part"][xs] != column["part"][y]) & (np.abs(column["d"][xs] - column["d"][y]) <= 1 - threshold + 1e-9)
                near = xs[fits & (100 * np.minimum(n, few) >= percent * np.maximum(n, few))]
                if len(near):
                    spread = np.sqrt(threshold * (1 - threshold) / np.minimum(np.minimum(column["n_shingles"][near], few), BUCKETS))
                    near = near[estimate(regs[near], regs[y]) >= threshold - 6 * spread]
                if not len(near):
                    continue
                seen[codes[first[y]:first[y + 1]]] = True
                both = np.array([np.count_nonzero(seen[codes[first[x]:first[x + 1]]]) for x in near])
                seen[codes[first[y]:first[y + 1]]] = False
                hit = near[100 * both >= percent * (column["n_shingles"][near] + few - both)]
                a += [int(column["node"][y])] * len(hit)
                b += column["node"][hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return solve


def _overlaps(size):
    def count(frames):
        for frame in frames:
            a, b = (frame.column(i).cast(pa.large_string()) for i in (2, 3))
            for low, high in cuts(b, 1 << 20):
                n = high - low
                # a side that comes again and again, as a centre does, is cut into shingles once
                code = a.slice(low, n).dictionary_encode()
                left, right = shingle_sets(code.dictionary, size), shingle_sets(b.slice(low, n), size)
                first_a = np.searchsorted(left[0], np.arange(len(code.dictionary) + 1))
                first_b = np.searchsorted(right[0], np.arange(n + 1))
                which = code.indices.to_numpy()
                both = np.zeros(n, np.int64)
                for k in range(n):
                    x = left[1][first_a[which[k]]:first_a[which[k] + 1]]
                    y = right[1][first_b[k]:first_b[k + 1]]
                    at = np.searchsorted(x, y)
                    both[k] = (x[np.minimum(at, len(x) - 1)] == y).sum()
                either = np.diff(first_a)[which] + np.diff(first_b) - both
                ids = [frame.column(i).slice(low, n) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(both), pa.array(either)], names=["a", "b", "both", "either"])

    return count


def components(links: DataFrame) -> DataFrame:
    """node, part: the smallest node reachable from each linked node. Rounds of large and small stars, each stored; a
    node's neighbours are only ever reduced to their minimum, never gathered."""
    edges = stored(links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).filter("u <> v").distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(now) == seen:
            break
        seen = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("part"))
