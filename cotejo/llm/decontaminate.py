"""Benchmark decontamination with suffix arrays over shards of the training text.

Every shard of documents (one Arrow batch, cut by bytes) gets a suffix array over its words: suffixes are sorted by
prefix doubling, only groups still tied are sorted again, and a suffix ends with its document. Each suffix of each
benchmark item is binary-searched in that array, one word deeper at a time, so the search yields the longest verbatim
match with its places, and on the way the places of the item's windows (``window`` consecutive words, or the whole
item where it has fewer). A document word inside any such place is hit.

The benchmark is the stated query set: it is read in blocks of at most ``block_words`` words, and each block is one
more pass inside the same stage, so what a task holds of it is bounded at any size. Documents are never shuffled.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased; they are compared by 64-bit hashes.
Null or empty texts have no words and are clean; an item without words, or with a null text, matches nothing; an item
with a null id marks words but is not listed; items that share an id are listed once. Repeated documents are judged
one by one.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import Words, map_texts, picked

WINDOW = 10
BLOCK_WORDS = 1 << 20
_SPANS = "array<struct<start:int,stop:int>>"


@dataclass
class Block:
    """Part of the benchmark: hashed words of its items one after the other, and their distinct windows."""

    words: np.ndarray
    item_end: np.ndarray  # of each word's item
    item: np.ndarray
    names: list
    window_at: np.ndarray  # first word of one copy of each distinct window
    window_size: np.ndarray
    owners: np.ndarray  # items of the windows, window by window
    owner_first: np.ndarray


def blocks_of(benchmark: DataFrame, window=WINDOW, block_words=BLOCK_WORDS, item_id="item_id", text="text") -> list[Block]:
    """The benchmark in blocks; rows arrive one partition at a time."""
    out, names, texts, size = [], [], [], 0
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("string")).toLocalIterator():
        names.append(row[0])
        texts.append(row[1] or "")
        size += len(texts[-1]) // 2 + 1  # no fewer than its words
        if size >= block_words:
            out.append(_block(names, texts, window))
            names, texts, size = [], [], 0
    if names or not out:
        out.append(_block(names, texts, window))
    return out


def _block(names, texts, window) -> Block:
    w = Words(pa.array(texts, pa.large_string()), alnum=True)
    words, item = w.hashes(), w.doc()
    item_end = w.first[1:][item]
    size = np.minimum(w.counts[item], window)
    at = np.flatnonzero(np.arange(len(words)) + size <= item_end)
    # equal windows meet by sorting (size, words); copies keep one place and a list of their items
    rows = np.zeros((len(at), window + 1), np.uint64)
    rows[:, 0] = size[at]
    for d in range(window):
        inside = d < size[at]
        rows[inside, d + 1] = words[at[inside] + d]
    _, one, group = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([group.ravel(), item[at]], 1), axis=0) if len(at) else np.zeros((0, 2), int)
    first = np.searchsorted(pairs[:, 0], np.arange(len(one) + 1))
    return Block(words, item_end, item, names, at[one], size[at[one]], pairs[:, 1], first)


def suffix_array(words, ends, depth):
    """Order of the suffixes by their first ``depth`` words or more; ``ends``: where each word's document stops."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    opens = np.ones(n, bool)
    opens[1:] = words[order][1:] != words[order][:-1]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, slots, 0))
    tied, step = slots, 1
    while step < depth:
        shut = np.append(opens[1:], True)  # a group of one opens and shuts at once
        tied = np.flatnonzero(~(opens & shut))
        if not len(tied):
            break
        at = order[tied]
        on = at + step
        inside = on < ends[at]
        key = rank[at] * np.int64(n + 1)
        key[inside] += rank[on[inside]] + 1
        again = np.argsort(key, kind="stable")
        at, key = at[again], key[again]
        order[tied] = at
        opens[tied] = np.append(True, key[1:] != key[:-1])
        rank[at] = tied[np.maximum.accumulate(np.where(opens[tied], np.arange(len(tied)), 0))]
        step *= 2
    return order


def search(words, ends, order, block: Block):
    """Per benchmark suffix: length and place of its longest match; per distinct window: its range in ``order``."""
    n, m = len(words), len(block.words)
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    length, place = np.zeros(m, np.int64), np.full(m, -1, np.int64)
    window_low, window_high = np.zeros(len(block.window_at), np.int64), np.zeros(len(block.window_at), np.int64)
    alive = np.arange(m) if n else np.zeros(0, np.int64)
    depth = 0
    while len(alive):
        target = block.words[alive + depth]
        a, b = low[alive], high[alive]
        left = _bisect(words, ends, order, a, b, depth, target, np.less)
        right = _bisect(words, ends, order, left, b, depth, target, np.less_equal)
        hit = right > left
        alive, depth = alive[hit], depth + 1
        low[alive], high[alive] = left[hit], right[hit]
        length[alive], place[alive] = depth, order[left[hit]]
        done = np.flatnonzero((block.window_size == depth) & (length[block.window_at] == depth))
        window_low[done], window_high[done] = low[block.window_at[done]], high[block.window_at[done]]
        alive = alive[alive + depth < block.item_end[alive]]
    return length, place, window_low, window_high


def _bisect(words, ends, order, low, high, depth, target, below):
    """First slot of each range whose word at ``depth`` is not below the target; past the document's end is lowest."""
    low, high = low.copy(), high.copy()
    going = np.flatnonzero(low < high)
    while len(going):
        mid = (low[going] + high[going]) >> 1
        at = order[mid]
        on = at + depth
        short = on >= ends[at]
        less = short | below(words[np.minimum(on, len(words) - 1)], target[going])
        low[going[less]] = mid[less] + 1
        high[going[~less]] = mid[~less]
        going = going[low[going] < high[going]]
    return low


def _shard(texts):
    w = Words(texts, alnum=True)
    doc = w.doc()
    return w, w.hashes(), doc, w.first[1:][doc]


def _mark(texts, block, depth):
    w, words, doc, ends = _shard(texts)
    order = suffix_array(words, ends, depth)
    _, _, low, high = search(words, ends, order, block)
    found = np.flatnonzero(high > low)
    many = high[found] - low[found]
    which = np.repeat(found, many)
    at = order[np.repeat(low[found] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())]
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + block.window_size[which], -1)
    hit = np.cumsum(steps[:-1]) > 0
    edge = np.zeros(len(words) + 1, bool)
    edge[w.first] = True
    before, after = np.append(False, hit[:-1]), np.append(hit[1:], False)
    start = np.flatnonzero(hit & (~before | edge[:-1]))
    stop = np.flatnonzero(hit & (~after | edge[1:])) + 1
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(start, w.first), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(start - w.first[doc[start]], pa.int32()), pa.array(stop - w.first[doc[start]], pa.int32())],
            ["start", "stop"],
        ),
    )
    pairs = np.unique(np.stack([doc[at], which], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    owned = np.diff(block.owner_first)[pairs[:, 1]]
    first = np.repeat(block.owner_first[:-1][pairs[:, 1]] - np.append(0, np.cumsum(owned)[:-1])[:len(owned)], owned)
    pairs = np.stack([np.repeat(pairs[:, 0], owned), block.owners[first + np.arange(owned.sum())]], 1)
    pairs = np.unique(pairs, axis=0)
    names = pa.array([block.names[i] for i in pairs[:, 1]], pa.string())
    items = pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1)), pa.int32()), names)
    return [pa.array(w.counts, pa.int64()), spans, items]


def contamination(documents: DataFrame, benchmark: DataFrame, window=WINDOW, block_words=BLOCK_WORDS, text="text", keep=None):
    """Per document: n_words, spans (hit word ranges), n_hit, items (ids with an occurring window), contaminated."""
    fields = [("n_words", "long"), ("spans", _SPANS), ("n_hit", "long"), ("items", "array<string>"), ("contaminated", "boolean")]
    kept = picked(documents, keep, fields)
    out = documents.select(*[documents[c] for c in kept], documents[text].cast("string").alias("__words_of"))
    blocks = blocks_of(benchmark, window, block_words)
    for k, block in enumerate(blocks):
        out = map_texts(
            out, lambda texts, b=block: _mark(texts, b, window), [(f"__n{k}", "long"), (f"__spans{k}", _SPANS), (f"__items{k}", "array<string>")],
            text="__words_of", keep=out.columns if k + 1 < len(blocks) else [c for c in out.columns if c != "__words_of"],
        )
    spans, items = F.col("__spans0"), F.col("__items0")
    if len(blocks) > 1:
        spans = F.array_sort(F.flatten(F.array(*[f"__spans{k}" for k in range(len(blocks))])))
        items = F.flatten(F.array(*[f"__items{k}" for k in range(len(blocks))]))
        seed = F.expr(f"named_struct('stop', 0, 'done', cast(array() as {_SPANS}))")
        spans = F.aggregate(spans, seed, _joined, lambda s: s["done"])
    out = out.select(*kept, F.col("__n0").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(F.filter(items, F.isnotnull))).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0)


def _joined(state, span):
    """Spans in order, cut so that none overlaps what is done."""
    start = F.greatest(span["start"], state["stop"])
    more = F.when(start < span["stop"], F.concat(state["done"], F.array(F.struct(start.alias("start"), span["stop"].alias("stop")))))
    return F.struct(F.greatest(state["stop"], span["stop"]).alias("stop"), F.coalesce(more, state["done"]).alias("done"))


def longest_matches(documents: DataFrame, benchmark: DataFrame, least=WINDOW, doc_id="doc_id", text="text") -> DataFrame:
    """item_id, item_word, length, doc_id, doc_word: the longest verbatim match of each benchmark suffix of ``least`` words
    or more, with one of its places. The result is bounded by the benchmark."""
    parts = []
    for block in blocks_of(benchmark, least):
        opens = np.searchsorted(block.item, block.item)
        depth = int(np.bincount(block.item, minlength=1).max())

        def find(frames, b=block, opens=opens, depth=depth):
            for frame in frames:
                w, words, doc, ends = _shard(frame.column(1).cast(pa.large_string()))
                length, place, _, _ = search(words, ends, suffix_array(words, ends, depth), b)
                good = np.flatnonzero(length >= least)
                at = place[good]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b.names[i] for i in b.item[good]], pa.string()), pa.array(good - opens[good], pa.int64()),
                        pa.array(length[good], pa.int64()), frame.column(0).take(pa.array(doc[at])), pa.array(at - w.first[doc[at]], pa.int64()),
                    ],
                    names=["item_id", "item_word", "length", "doc_id", "doc_word"],
                )

        source = documents.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
        parts.append(source.mapInArrow(find, "item_id string, item_word long, length long, doc_id long, doc_word long"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = F.min(F.struct(-F.col("length"), F.col("doc_id"), F.col("doc_word"))).alias("best")
    best = found.groupBy("item_id", "item_word").agg(best)
    return best.select("item_id", "item_word", (-F.col("best.col1")).alias("length"), "best.doc_id", "best.doc_word")


def clean(documents: DataFrame, benchmark: DataFrame, text="text", **options) -> DataFrame:
    """The documents that no benchmark window touches, with their own columns."""
    packed = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row_"), documents[text].alias("text_"))
    judged = contamination(packed, benchmark, text="text_", keep=["row_"], **options)
    return judged.filter(~F.col("contaminated")).select("row_.*")
