"""Manifest, resampling and shards against plain versions, on whole small tables and on awkward rows."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cotejo.llm import manifest, queries, ranks, resampling, sharding, url_filter
from tests.llm.test_operators import AWKWARD, SF, empty

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.fixture(scope="module")
def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    frame = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("rank", "TOTAL", "size", "shard", "slot", "weight", "SCORE", "n_words", "n_features", "node", "tree", "item", "kept", "id_", "text_", "bucket")
    return frame.selectExpr("*", *[f"'extra' AS {c}" for c in clashing])


# ---- ranks


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranked(spark, groups):
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"g{i}", i * 7919 % 503 if i % 11 else None, i) for i in range(900)]
    got = ranks.ranked(spark.createDataFrame(rows, "g string, v long, i long"), groups, ["v", F.col("i").desc()]).collect()
    want = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[2])):
        want[r[0] if groups else 0].append(r[2])
    found = defaultdict(dict)
    for r in got:
        found[r["g"] if groups else 0][r["rank"]] = r["i"]
        assert r["total"] == len(want[r["g"] if groups else 0])
    assert {g: [x[i] for i in range(len(x))] for g, x in found.items()} == dict(want)


# ---- 11 manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h(*x[i:i + 3]) for i in range(0, len(x), 3)])
    return levels


def plain_climb(levels, i, digest):
    """(siblings from the leaf up, root that ``digest`` in place i gives)."""
    proof = []
    for x in levels[:-1]:
        low = i - i % 3
        run = x[low:low + 3]
        proof += [d for k, d in enumerate(run) if k != i - low]
        run[i - low] = digest
        digest, i = h(*run), i // 3
    return proof, digest


def plain_manifest(rows, show):
    """[(doc_id, leaf, subroot, root, proof, folded)] of (doc_id, text, lang, source, n_chars) rows."""
    def hashed(r, text):
        return leaf((r[0], r[3], r[2], r[4], text))

    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((r[0] is not None, r[0] or 0, hashed(r, r[1]), hashed(r, show(r)), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top, out = plain_levels([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for i, x in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            proof, digest = plain_climb(trees[s], i, x[3])
            more, digest = plain_climb(top, k, digest)
            out.append((x[4][0], x[2], trees[s][-1][0], top[-1][0], tuple(proof + more), digest))
    return out


def without_breaks(r):
    return r[1].replace("\n", "") if r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]


def test_manifest_query(spark, table):
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in queries.op11_merkle_manifest(spark, SF).collect()]
    want = [(*r[:4], h(*r[4]), r[5], r[5] == r[3]) for r in plain_manifest(table, without_breaks)]
    assert sorted(got) == sorted(want)
    assert {True, False} == {r[6] for r in got}


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest_blocks(spark, table, height):
    """Blocks of any height, and so any number of rounds, give the same trees."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = manifest.manifest(docs, COLUMNS, "source", "doc_id", ("doc_id",), {"text": F.upper("text")}, height).proofs().collect()
    want = plain_manifest(table, lambda r: r[1].upper())
    assert sorted((r["kept"]["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["proof"]), r["folded_root"]) for r in got) == sorted(want)


def test_manifest_awkward(spark, awkward):
    trees = manifest.manifest(awkward, COLUMNS, "source", "doc_id", ("doc_id", "rank", "tree"))
    got = trees.proofs().collect()
    want = plain_manifest(AWKWARD, lambda r: r[1])
    key = lambda r: (str(r[0]), r[1], r[4])
    assert sorted(((r["kept"]["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["proof"]), r["folded_root"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["verified"] and r["kept"]["rank"] == "extra" for r in got)
    assert manifest.manifest(empty(spark), COLUMNS, "source", "doc_id", ("doc_id",)).proofs().count() == 0


def test_manifest_hot_group(spark):
    """One group of 5,000 null-id rows, equal ones among them, over several rounds of blocks."""
    rows = [(None, f"t{i % 1700}", "en", "hot", i % 1700) for i in range(5000)] + [(i, "x", "en", f"s{i}", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = manifest.manifest(docs, COLUMNS, "source", "doc_id", ("doc_id",), height=3).proofs().collect()
    want = plain_manifest(rows, lambda r: r[1])
    assert Counter((r["leaf"], r["subroot"], r["root"], tuple(r["proof"]), r["folded_root"]) for r in got) == Counter(r[1:] for r in want)


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout(levels):
    """Every node has its own place; both halves of a split are contiguous."""
    layout = manifest.Layout(levels)
    places = np.concatenate([layout.address(d, np.arange(3**d)) for d in range(levels)])
    assert sorted(places) == list(range(layout.size))
    if levels > 1:
        upper = levels // 2
        top = np.concatenate([layout.address(d, np.arange(3**d)) for d in range(upper)])
        assert sorted(top) == list(range(manifest.size_of(upper)))
        lower = np.concatenate([layout.address(d, np.arange(3**(d - upper), 2 * 3**(d - upper))) for d in range(upper, levels)])
        assert sorted(lower - lower.min()) == list(range(manifest.size_of(levels - upper)))


# ---- 12 resampling


def plain_features(text, n=3):
    words = WORDS.findall((text or "").translate(UPPER))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain_resampled(docs, target, percent=5, buckets=10000, least=20, n=3):
    """{place: (doc_id, n_features, weight, score, drawn)} by position of the row."""
    have, want = Counter(), Counter()
    found = [plain_features(t, n) for _, t in docs]
    for _, codes in found:
        have.update(c % buckets for c in codes)
    for t in target:
        want.update(c % buckets for c in plain_features(t, n)[1])
    s, t = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (words, codes) in zip(docs, found):
        weight = sum(gain[c % buckets] for c in codes)
        x = int(h(f"42:{'' if i is None else i}")[:8], 16)
        out.append([i, len(codes), weight, weight + math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))), None, words >= least])
    long = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(long[:percent * len(long) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_resampling_query(spark, table):
    bench = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    got = [tuple(r) for r in queries.op12_importance_resampling(spark, SF).collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted(plain_resampled([r[:2] for r in table], bench), key=lambda r: r[0])


@pytest.mark.parametrize("n, buckets, shard", [(3, 10000, 1), (1, 7, 1 << 20), (2, 70000, 300)])
def test_resampling_awkward(spark, awkward, n, buckets, shard):
    target = spark.createDataFrame([("No ID here!",), (None,), ("",), ("passage1 passage2",)], "text string")
    got = resampling.resampled(awkward, target, 50, n, buckets, 5, shard_bytes=shard).collect()
    want = plain_resampled([r[:2] for r in AWKWARD], [r[0] for r in target.collect()], 50, buckets, 5, n)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == Counter(r[:4] for r in want)
    assert sorted(r["rank"] for r in got if r["rank"]) == sorted(r[4] for r in want if r[4])
    assert sorted((r["rank"], r["score"], r["doc_id"] or 0) for r in got if r["rank"]) == sorted((r[4], r[3], r[0] or 0) for r in want if r[4])
    assert got[0]["tree"] == "extra" and len(got) == len(AWKWARD)


def test_resampling_empty(spark, awkward):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resampled(empty(spark), nothing).count() == 0
    got = resampling.resampled(awkward, nothing, keep=["doc_id"]).collect()
    want = plain_resampled([r[:2] for r in AWKWARD], [])
    assert Counter((r["doc_id"], r["weight"]) for r in got) == Counter((r[0], r[2]) for r in want)


def test_spans():
    flat = resampling.collapsed(b"  The Quick--brown\tFOX9 \xc3\x89t\xc3\xa9")
    assert flat == b"the quick brown fox9 \xc3\x89t\xc3\xa9"
    assert resampling.spans(flat, resampling.gram_pattern(3), 3).tolist() == [[3, 9, 15], [9, 15, 20], [15, 20, 26], [20, 26, -1], [26, -1, -1]]
    assert resampling.spans(b"", resampling.gram_pattern(2), 2).shape == (0, 2)


# ---- older operators on awkward rows


def test_very_long_host_labels(spark):
    """A label of 60,000 letters is split like a short one, words across the pieces it is looked at in included."""
    text = "alpha beta gamma " * 50
    label = "alphabetagamma" * 4300
    rows = [(None, f"http://{label}.org/x", f"<p>{text}</p>"), (2, "http://betaalpha.org/", "<p></p>"), (2, "http://betaalpha.org/", None), (3, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("x"))
    got = url_filter.judged(pages, queries.URL_RULES).collect()
    assert sorted((r["page_id"] or 0, len(r["host"]), r["rule"]) for r in got) == [(0, len(label) + 4, None), (2, 13, None), (2, 13, None), (3, 0, None)]
    counts = spark.createDataFrame([("alpha", 50), ("beta", 50), ("gamma", 50)], "word string, n long")
    names = spark.createDataFrame([(label,), ("betaalpha",), ("",)], "label string")
    words = {r["label"]: r["words"] for r in url_filter.segmented(names, counts).collect()}
    assert words == {label: ["alpha", "beta", "gamma"] * 4300, "betaalpha": ["beta", "alpha"]}


def test_held_out_of_a_null_id_is_false(spark):
    docs = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "doc_id long")
    for parts, part in ((3, 1), (5, 0)):
        got = {r["doc_id"]: r["held_out"] for r in docs.select("doc_id", queries.told_held_out(parts, part)).collect()}
        assert got == {i: i is not None and zlib.crc32(str(i).encode()) % parts == part for i in (None, 1, 2, 3, 4)}


# ---- 13 shards


def plain_shards(texts, shards=16):
    """{text: shard} by one heap over all groups."""
    sizes = Counter()
    for t in texts:
        sizes[t or ""] += len((t or "").encode()) + 1
    heap, out = [(0, s) for s in range(shards)], {}
    for t, size in sorted(sizes.items(), key=lambda x: (-x[1], hashlib.md5(x[0].encode()).hexdigest())):
        load, s = heapq.heappop(heap)
        out[t] = s
        heapq.heappush(heap, (load + size, s))
    return out


def test_shards_query(spark, table):
    where = plain_shards([r[1] for r in table])
    got = queries.op13_shards(spark, SF).collect()
    texts = {r[0]: r[1] for r in table}
    slots = defaultdict(list)
    for r in sorted(got, key=lambda r: r["doc_id"]):
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
        assert r["shard"] == where[text]
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(table) and all(v == list(range(len(v))) for v in slots.values())


def test_shards_bundles(spark):
    """Far more groups than a heap takes: groups stay together and loads stay near equal, a hot group besides."""
    rows = [(i, f"{i % 2500} " + "x" * (i * 37 % 400)) for i in range(3000)] + [(None, "hot text " * 20)] * 1500 + [(7, None), (7, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.sharded(docs, 4, most=64, block=48).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert all(len({r["shard"] for r in got if (r["text"] or "") == t}) == 1 for t in {r[1] or "" for r in rows})
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    hot = max(load.values())
    assert hot == 1500 * (len("hot text " * 20) + 1)  # more than a fourth of all: it has a shard of its own
    assert sorted(load.values())[2] - min(load.values()) < 0.03 * sum(load.values())
    for s in load:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_awkward(spark, awkward):
    got = sharding.sharded(awkward, 3).collect()
    where = plain_shards([r[1] for r in AWKWARD], 3)
    assert Counter((r["doc_id"], r["text"], r["shard"]) for r in got) == Counter((r[0], r[1], where[r[1] or ""]) for r in AWKWARD)
    assert {r["node"] for r in got} == {"extra"} and len(got[0]) == len(awkward.columns) + 1
    assert sharding.sharded(empty(spark)).count() == 0


def test_schedule_is_longest_first():
    assert sharding.scheduled([8, 7, 6, 5, 4], 2) == [0, 1, 1, 0, 0]
