"""Helpers the operators of this package share: Arrow batches of whole texts, words as numpy arrays, stored frames.

Batch operators keep the columns named in ``keep`` (all by default) and add their own; a kept column whose name
equals a result's, in any case, gives way to the result. Null columns, ids and repeated rows pass through unchanged:
no batch operator needs a unique id.
"""

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SHARD_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_ALNUM = np.array([48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNIT = np.uint64(pow(int(_BASE), -1, 1 << 64))


def shared_folder(spark) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where a local session sets none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, safe from lost executors, with no lineage."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def picked(df: DataFrame, keep, fields) -> list:
    """The kept columns' names: those asked for, without those a result replaces."""
    taken = {name.lower() for name, _ in fields}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def map_texts(df: DataFrame, compute, fields, text="text", keep=None, shard_bytes=SHARD_BYTES) -> DataFrame:
    """Kept columns plus ``fields`` ((name, Spark DDL type) pairs), computed shard by shard.

    ``compute(texts)`` gets a string array of whole texts, at most ``shard_bytes`` of them unless one is longer, and
    returns one array per field. Memory is bounded by the shard and by the longest text.
    """
    names = picked(df, keep, fields)
    source = df.select(*[df[c] for c in names], df[text].cast("string").alias("__text"))
    schema = StructType([*source.schema.fields[:-1], *StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields)).fields])

    def batches(frames):
        for frame in frames:
            column = frame.column(frame.num_columns - 1).cast(pa.large_string())
            for low, high in cuts(column, shard_bytes):
                values = compute(column.slice(low, high - low))
                kept = [frame.column(i).slice(low, high - low) for i in range(frame.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(kept + values, names=schema.names)

    return source.mapInArrow(batches, schema)


def cuts(column, most):
    """Row ranges of at most ``most`` bytes, or of one row."""
    ends = offsets_of(column)
    low, rows = 0, len(column)
    while low < rows:
        high = int(np.searchsorted(ends, ends[low] + most, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def offsets_of(column):
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)


def raw(column):
    """(bytes of all texts, offset of each text and the end); a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    ends = offsets_of(column)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


class Words:
    """The words of many texts: byte ranges, the first word of each text, and a 64-bit hash of each word."""

    def __init__(self, column, alnum, lower=True):
        data, self.ends = raw(column)
        self.data = _LOWER[data] if lower else data
        inside = _ALNUM[self.data] if alnum else ~_SPACES[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.ends] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.ends)
        self.counts = np.diff(self.first)

    def doc(self):
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self):
        powers = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[0][:-1], out=sums[1:])
        out = (sums[self.stops] - sums[self.starts]) * powers[1][self.starts]
        return mix(out ^ (self.stops - self.starts).astype(np.uint64))


def _powers(n):
    """Powers of the base and of its inverse; kept for the usual shard."""
    if len(_kept[0]) < n:
        made = []
        for base in (_BASE, _UNIT):
            x = np.full(max(n, SHARD_BYTES + 1), base, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if n > SHARD_BYTES + 1:
            return made
        _kept[:] = made
    return _kept[0][:n], _kept[1][:n]


_kept = [(), ()]


def mix(x):
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(parts):
    """One hash of several hash arrays in order."""
    out = np.full_like(parts[0], 0x51ED270B0F31B3A5)
    for p in parts:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + p)
    return out
