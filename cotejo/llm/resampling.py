"""Importance resampling towards a target distribution: hashed n-grams, log-ratio weights, Gumbel top-k draw.

A text is lower-cased (A-Z only) and its separators collapse to single spaces; ``regex`` then scans it once with
``overlapped=True``: the pattern, held between look-arounds to whole words, matches at every word and its groups give
the spans of the n-grams that begin there. The spans' CRC-32 modulo the number of buckets are the features. A corpus and a target
are both counted by bucket; a bucket's gain is the floored, thousandfold log of the ratio of its smoothed shares, a document's weight
the sum of the gains of its features. A document's score adds Gumbel noise taken from its id, so the best scores are a
draw without replacement in proportion to the weights, and reruns agree.

One pass of Python reads the texts; it stores the buckets of each document (2 bytes a feature where 65,536 buckets do), from
which counts and weights are summed. The counts, one long a bucket for corpus and target, are the one thing that
passes through the driver. The draw is a rank in a global order (``ranked``): no task holds more than its range.

Null and empty texts have no features, weight 0 and are never drawn. A null id takes its noise from the empty string.
Ties go to the smaller id (null first); rows of one id and score are interchangeable and each has a rank of its own. An
empty corpus gives no rows; an empty target gives every bucket the share of a bucket not met. A kept column named like
a result gives way to it.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import SHARD_BYTES, map_texts, picked, raw, stored
from cotejo.llm.ranks import ranked

NGRAMS = 3
BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 42

#: A-Z in lower case, what is no word character as a space.
_FLAT = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def _crc_table():
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def gram_pattern(n):
    """One match a word: group k ends where the run of k words that begins there does."""
    inner = ""
    for _ in range(n - 1):
        inner = rf"(?:( [^ ]+){inner})?"
    return regex.compile(rf"(?<![^ ])([^ ]+)(?![^ ]){inner}(?![^ ])".encode())


def collapsed(text: bytes) -> bytes:
    return b" ".join(text.translate(_FLAT).split())


def spans(flat: bytes, pattern, n):
    """(words, n) array of the ends of the runs of 1 … n words from each word on; -1 where the text ends before."""
    groups = range(1, n + 1)
    ends = [e for m in pattern.finditer(flat, overlapped=True) for e in m.end(*groups)] if n > 1 else [m.end() for m in pattern.finditer(flat, overlapped=True)]
    return np.array(ends, np.int64).reshape(-1, n)


def crc_on(data, starts, stops, crc):
    """CRC-32 registers carried on over byte ranges, all of them one byte at a time."""
    order = np.argsort(starts - stops, kind="stable")
    lengths, at, crc = (stops - starts)[order], starts[order], crc[order].copy()
    live = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    for k, n in enumerate(live):
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def features(texts, pattern, n, buckets):
    """(words of each text, features of each text, buckets of all features, text by text and run length by run length)."""
    data, ends = raw(texts)
    data, n_words, n_features, found = data.tobytes(), [], [], []
    flats = [collapsed(data[low:high]) for low, high in zip(ends[:-1], ends[1:])]
    places = [spans(flat, pattern, n) for flat in flats]
    shift = np.concatenate([[0], np.cumsum([len(f) for f in flats])])
    joined = np.frombuffer(b"".join(flats), np.uint8)
    stops = np.concatenate([np.where(p < 0, -1, p + s) for p, s in zip(places, shift)]) if places else np.zeros((0, n), np.int64)
    counts = np.array([len(p) for p in places], np.int64)
    first = np.cumsum(counts) - counts
    starts = np.empty(len(stops), np.int64)
    starts[1:] = stops[:-1, 0] + 1
    starts[first[counts > 0]] = shift[:-1][counts > 0]
    doc = np.repeat(np.arange(len(counts)), counts)
    crc, at, live, codes, docs = np.full(len(stops), 0xFFFFFFFF, np.uint32), starts, np.arange(len(stops)), [], []
    for k in range(n):
        live = live[stops[live, k] >= 0]
        crc[live] = crc_on(joined, at[live], stops[live, k], crc[live])
        codes.append((~crc[live]) % np.uint32(buckets))
        docs.append(doc[live])
        at = stops[:, k]
    codes, docs = np.concatenate(codes), np.concatenate(docs)
    return counts, np.bincount(docs, minlength=len(counts)), codes[np.argsort(docs, kind="stable")]


def bucketed(df: DataFrame, ngrams=NGRAMS, buckets=BUCKETS, text="text", keep=None, shard_bytes=SHARD_BYTES) -> DataFrame:
    """Kept columns, n_words, n_features and ``buckets_`` (binary: the bucket of every feature, repeats too)."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def compute(texts):
        n_words, n_features, codes = features(texts, gram_pattern(ngrams), ngrams, buckets)
        ends = np.concatenate([[0], np.cumsum(n_features)]) * kind.itemsize
        data = pa.py_buffer(codes.astype(kind).tobytes())
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n_words), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), data])
        return [pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), blobs.cast(pa.binary())]

    return map_texts(df, compute, [("n_words", "long"), ("n_features", "long"), ("buckets_", "binary")], text, keep, shard_bytes)


def bucket_counts(rows: DataFrame, buckets=BUCKETS) -> DataFrame:
    """bucket int, n long over all rows of ``bucketed``; every task adds up its own first."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(frames):
        sums = np.zeros(buckets, np.int64)
        for frame in frames:
            for blob in frame.column(0):
                sums += np.bincount(np.frombuffer(blob.as_buffer(), kind), minlength=buckets)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(sums[met])], names=["bucket", "n"])

    return rows.select("buckets_").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets=BUCKETS) -> np.ndarray:
    """The gain of every bucket; ``corpus`` and ``target`` are (bucket, n) frames of at most ``buckets`` rows."""
    counts = np.zeros((2, buckets), np.int64)
    for i, frame in enumerate((corpus, target)):
        for r in frame.toLocalIterator():
            counts[i, r["bucket"]] = r["n"]
    have, want = counts.astype(np.float64)
    ratio = (want + 1) * (have.sum() + buckets) / ((have + 1) * (want.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``bucketed`` rows with ``weight`` (the sum of their features' gains) in place of the buckets."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    others = [c for c in rows.columns if c != "buckets_"]
    schema = rows.select(*others).withColumn("weight", F.lit(0).cast("long")).schema

    def weigh(frames):
        for frame in frames:
            blobs = frame.column(frame.num_columns - 1)
            weights = [int(gain[np.frombuffer(b.as_buffer(), kind)].sum()) for b in blobs]
            yield pa.RecordBatch.from_arrays([*frame.columns[:-1], pa.array(weights, pa.int64())], names=schema.names)

    return rows.select(*others, "buckets_").mapInArrow(weigh, schema)


def noise(identity, seed=SEED):
    """Thousandfold floored Gumbel noise from the first 32 bits of SHA-256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, percent=5, ngrams=NGRAMS, buckets=BUCKETS, least_words=LEAST_WORDS, seed=SEED,
    identity="doc_id", text="text", keep=None, shard_bytes=SHARD_BYTES,
) -> DataFrame:
    """Kept columns of every document, n_words, n_features, weight, score and rank (1, 2, 3 …; null if not drawn).

    ``percent`` of the documents of at least ``least_words`` words are drawn (rounded down), those of the highest scores.
    """
    results = [(n, "") for n in ("n_words", "n_features", "weight", "score", "rank")]
    kept = picked(docs, keep, results)
    whole = docs.select(docs[identity].alias("id_"), F.struct(F.lit(True).alias("any_"), *[docs[c] for c in kept]).alias("kept_"), docs[text].alias("text_"))
    rows = stored(bucketed(whole, ngrams, buckets, "text_", ["id_", "kept_"], shard_bytes))
    wanted = bucketed(target, ngrams, buckets, text, [], shard_bytes)
    scored = weighed(rows, gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), buckets))
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("id_"), seed)).withColumn("short_", F.col("n_words") < least_words)
    placed = ranked(scored, ["short_"], [F.col("score").desc(), F.col("id_").asc_nulls_first()])
    drawn = ~F.col("short_") & (F.col("rank") < F.floor(F.lit(percent) * F.col("total") / 100))
    return placed.select(
        *[F.col("kept_")[c].alias(c) for c in kept], "n_words", "n_features", "weight", "score", F.when(drawn, F.col("rank") + 1).alias("rank")
    )
