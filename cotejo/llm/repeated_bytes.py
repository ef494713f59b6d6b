"""Suffix-array dedup of long byte strings: column-wise construction of the collection's Burrows-Wheeler transform.

Every byte covered by a ``length``-byte string that also starts earlier (smaller id, or earlier in the same document) is
removed. The collection is dealt so that equal strings meet and each part is small:

1. Anchors. Each window of ``length`` bytes names its leftmost smallest hashed ``GRAM``-byte gram; the windows of one
   anchor form one segment of at most ``2 * length - GRAM`` bytes, and equal windows have equal anchors at equal places.
   One scan sends every anchor's hash, once per shard, to its bucket; only anchors that come back are kept.
2. Segments of such anchors, equal ones of a shard as one, go to their anchor's bucket.
3. In a bucket the distinct segments that share an anchor are the collection. The transform is built column by column:
   each round puts one more symbol of every segment, from the back, into the rows so far; the place follows from the
   row of the suffix before (last-to-first step), and the common prefix with the row above is updated for the new row
   and for the one below it. The rows live in sequential files beyond ``FILE_BYTES``. Rows whose common prefix
   reaches ``length`` are one group of equal windows: the earliest stays.
4. The removed window ranges return to their documents, whose bytes are cut.

Anchors that ``HOT_DOCUMENTS`` or more of about ``SAMPLE`` sampled documents hold are hot: such a list is bounded by the
sample, and only steers the load. Their windows are dealt one by one under a 128-bit digest, once per shard with the
earliest place, and settled in step 1's buckets. Copies of a segment never travel twice from a shard either.

Null and empty texts have no bytes. Documents that share an id are ordered by the hash of their text, repeated rows
among each other by arrival; null ids come last. Extra columns are carried only where ``keep`` names them.
"""

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cotejo.llm.common import SHARD_BYTES, _powers, cuts, mix, raw, stored

LENGTH = 100
GRAM = 40
PIECE_BYTES = 128 << 10
SAMPLE, HOT_DOCUMENTS = 20_000, 40
BATCH = 16_384
BUCKET_BYTES = 20 << 20
FILE_BYTES = 256 << 20
_LAST = np.iinfo(np.int64).max
_STEP = 256  # rows of a block of the transform; fewer than 256 matches above a place keep their count in one byte
_KEYS = np.arange(_STEP * 256) // _STEP
_ABOVE = np.tri(_STEP, k=-1, dtype=bool)


# ---- anchors ----------------------------------------------------------------------------------------------------------


def rolled(data, size):
    """Hash of the ``size`` bytes from each place."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    ahead, back = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ahead[:-1], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * back[:n])


def segments(data, ends, length=LENGTH, gram=GRAM):
    """(anchor hash, document, first window, last window, anchor) of each segment; places count from the shard's start.

    Documents are worked off some at a time, so that the arrays of a step stay in a core's cache.
    """
    parts, low = [], 0
    while low < len(ends) - 1:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + PIECE_BYTES, side="right")) - 1)
        base = ends[low]
        hashes, doc, first, last, place = _segments(data[base:ends[high]], ends[low:high + 1] - base, length, gram)
        parts.append((hashes, doc + low, first + base, last + base, place + base))
        low = high
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else _segments(data, ends, length, gram)


def _segments(data, ends, length, gram):
    hashes = rolled(data, gram)
    wide = length - gram + 1
    n = len(hashes) - wide + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4
    # smallest hash in each run of ``wide`` places: minima over powers of two, then two that overlap
    minima, reach = [np.append(hashes, np.full(2 * wide, np.iinfo(np.uint64).max, np.uint64))], 1
    while reach * 2 <= wide:
        minima.append(np.minimum(minima[-1][:-reach], minima[-1][reach:]))
        reach *= 2
    low = np.minimum(minima[-1][:n], minima[-1][wide - reach:wide - reach + n])
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[:n]
    inside = np.arange(n) + length <= ends[1:][doc]
    # a run of windows with one minimum keeps its anchor until it leaves the window or a smaller one comes
    starts = np.flatnonzero(inside & np.append(True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]))
    stops = np.flatnonzero(inside & np.append((low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~inside[1:], True))
    value = low[starts]
    found, first, last = [], [], []
    value_at = _first_at(minima, value, starts)
    if not len(starts):
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4
    while len(starts):  # equal grams close together: the run goes on with the next of them
        stay = np.minimum(stops, value_at)
        found.append(value_at)
        first.append(starts)
        last.append(stay)
        more = stay < stops
        starts, stops, value = stay[more] + 1, stops[more], value[more]
        value_at = _first_at(minima, value, starts)
    place, first, last = (np.concatenate(x) for x in (found, first, last))
    order = np.argsort(first, kind="stable")
    place, first, last = place[order], first[order], last[order]
    return hashes[place], doc[first], first, last, place


def _first_at(minima, value, starts):
    """First place from each start on that has the value, which is the smallest there and one of the next ``wide``.

    ``minima[k]`` holds the smallest of 2^k hashes from each place on: a stretch of larger ones is passed at once.
    """
    at = starts.copy()
    for k in range(len(minima) - 1, -1, -1):
        at[minima[k][at] > value] += 1 << k
    return at


# ---- column-wise transform --------------------------------------------------------------------------------------------


class Rows:
    """Rows of the transform in suffix order: symbol before the suffix, common prefix with the row above, and the suffix
    itself (segment << 16 | length). Large ones are files of the task's own folder, written and read front to back."""

    def __init__(self, size, folder, common, suffix):
        make = (lambda kind: np.empty(size, kind)) if size * 6 < FILE_BYTES else (
            lambda kind: np.memmap(tempfile.TemporaryFile(dir=folder), kind, "w+", shape=(size,)))
        self.common, self.suffix = make(common), make(suffix)
        size = -(-size // _STEP) * _STEP  # whole blocks; what lies past the last row is never counted
        self.blocks = make(np.uint8).reshape(-1, _STEP)
        self.before = self.blocks.reshape(-1)[:len(self.common)]

    def stepped(self, kinds):
        """Row of the grown transform each row's symbol leads to (last-to-first step), as a function of places.

        It counts the rows with a smaller symbol, and those above with the same one: per block by a histogram of all
        rows, inside the place's own block by comparing its bytes."""
        counts = np.zeros((len(self.blocks) + 1, kinds), np.int64)
        for low in range(0, len(self.before), len(_KEYS)):
            part = self.before[low:low + len(_KEYS)]
            n = -(-len(part) // _STEP)
            key = _KEYS[:len(part)] * kinds + part
            counts[low // _STEP + 1:low // _STEP + 1 + n] = np.bincount(key, minlength=n * kinds).reshape(n, kinds)
        np.cumsum(counts, axis=0, out=counts)
        smaller = np.append(0, np.cumsum(counts[-1])[:-1])

        def to(place):
            symbol, out = self.before[place], np.empty(len(place), np.int64)
            for low in range(0, len(place), _STEP * 4):
                at, kind = place[low:low + _STEP * 4], symbol[low:low + _STEP * 4]
                same = (self.blocks[at // _STEP] == kind[:, None]) & _ABOVE[at % _STEP]
                eights = same.view(np.uint64).sum(axis=1)  # up to 32 in each of its bytes
                inside = (eights * np.uint64(0x0101010101010101)) >> np.uint64(56)
                out[low:low + len(at)] = smaller[kind] + counts[at // _STEP, kind] + inside.astype(np.int64)
            return out

        return to, int(counts[-1, 0])


def transform(columns, sizes, limit, folder=None):
    """Rows of the collection whose segments are the right-aligned rows of ``columns``; ``common`` is cut at ``limit``.

    A segment's end sorts before every symbol, earlier segments' ends first; common prefixes stop at ends.
    """
    count, width = columns.shape
    wide = np.zeros((count, width + limit + 8), np.uint8)
    wide[:, :width] = columns
    span = width + limit + 8
    words = np.ndarray(wide.size - 7, "<u8", wide, strides=(1,))  # the eight bytes from each place on

    def shared(a, b):
        """Common prefix of two suffixes, cut at the limit and at both lengths."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        at_a, at_b = ((x >> 16) * span + width - (x & 65535) for x in (a, b))
        for step in range(0, limit, 8):
            differ = words[at_a[open_] + step] ^ words[at_b[open_] + step]
            equal = differ == 0
            low = differ & (~differ + np.uint64(1))  # lowest bit that differs
            out[open_[~equal]] = step + (np.log2(low[~equal].astype(np.float64)).astype(np.int64) >> 3)
            out[open_[equal]] = step + 8
            open_ = open_[equal]
            if not len(open_):
                break
        return np.minimum(np.minimum(out, limit), np.minimum(a & 65535, b & 65535))

    # symbols are the bytes in use, numbered in order from one (UTF-8 has no byte 255); zero stands before a whole segment
    used = np.bincount(columns.ravel(), minlength=256) > 0
    symbols = np.cumsum(used).astype(np.uint8)[columns]
    alphabet = int(used.sum()) + 1
    kinds = (np.uint8 if limit < 256 else np.uint16, np.int32 if count < 1 << 15 else np.int64)
    rows = Rows(count, folder, *kinds)
    rows.before[:], rows.common[:], rows.suffix[:] = symbols[:, -1], 0, np.arange(count) << 16
    place, live = np.arange(count), np.arange(count)
    for done in range(1, width + 1):
        going = sizes[live] >= done
        to, ends = rows.stepped(alphabet)  # whole segments have no symbol before them: they lead nowhere
        place, live = to(place[going]) - ends + count, live[going]
        if not len(live):
            break
        sort = np.argsort(place, kind="stable")
        at, who = place[sort], live[sort]
        total = len(rows.before) + len(live)
        old = np.ones(total, bool)
        old[at] = False
        grown = Rows(total, folder, *kinds)
        last = sizes[who] == done
        grown.before[at] = np.where(last, 0, symbols[who, width - 1 - min(done, width - 1)])
        grown.suffix[at] = (who << 16) | done
        grown.before[old], grown.common[old], grown.suffix[old] = rows.before, rows.common, rows.suffix
        fresh = ~old
        fresh[1:] |= ~old[:-1]
        fresh[0] = False
        near = np.flatnonzero(fresh)
        grown.common[near] = shared(grown.suffix[near - 1].astype(np.int64), grown.suffix[near].astype(np.int64))
        rows = grown
    rows.before[:] = np.append(0, np.flatnonzero(used) + 1).astype(np.uint8)[rows.before]  # bytes plus one
    return rows


def repeated_windows(texts, length=LENGTH):
    """Groups of equal windows in a list of distinct byte strings: (string, offset, group) of windows in groups of two or more."""
    sizes = np.array([len(t) for t in texts])
    width = int(sizes.max())
    columns = np.zeros((len(texts), width), np.uint8)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts)), sizes)
    columns[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - width, sizes)] = flat
    with tempfile.TemporaryDirectory() as folder:
        rows = transform(columns, sizes, length, folder)
        suffix, common = rows.suffix.astype(np.int64), np.asarray(rows.common)
        whole = (suffix & 65535) >= length
        suffix, same = suffix[whole], (common[whole] >= length)
        del rows
    # between two windows with a long common prefix there is no shorter suffix, so neighbours among windows suffice
    group = np.cumsum(~same)
    twin = same.copy()
    twin[:-1] |= same[1:]
    who = suffix[twin] >> 16
    return who, sizes[who] - (suffix[twin] & 65535), group[twin]


# ---- jobs -------------------------------------------------------------------------------------------------------------

_DEALT = "bucket long, kind int, head binary, body binary"
_TOLD = "id_ long, key_ long, kind int, body binary"
_HASHES, _WINDOWS, _REMOVED = 0, 1, 2


def _pack(*arrays):
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _squeezed(blob):
    """What goes through the large shuffles: its length, then the bytes in zstd, denser than the shuffle's own codec."""
    return len(blob).to_bytes(8, "little") + pa.compress(blob, "zstd", asbytes=True)


def _whole(blob):
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def _unpack(blob, *kinds):
    """Arrays of equal length packed one after the other."""
    n, at, out = len(blob) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _batch(rows, schema_names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=schema_names)


def _dealt(rows):
    return _batch(rows, ["bucket", "kind", "head", "body"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()])


def _shards(frames):
    """(ids, keys, bytes, ends, batch, low, high) of each shard."""
    for frame in frames:
        ids, keys, column = frame.column(0).to_numpy(), frame.column(1).to_numpy(), frame.column(2).cast(pa.large_string())
        for low, high in cuts(column, SHARD_BYTES):
            data, ends = raw(column.slice(low, high - low))
            yield ids[low:high], keys[low:high], data, ends, frame, low


def _removed_rows(ids, keys, first, last, kind=_REMOVED):
    """One row per document with its removed window ranges."""
    order = np.lexsort((first, keys, ids))
    ids, keys, first, last = ids[order], keys[order], first[order].astype(np.int32), last[order].astype(np.int32)
    cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))) if len(ids) else []
    stops = np.append(cut[1:], len(ids)) if len(ids) else []
    return [(int(ids[a]), int(keys[a]), kind, _pack(first[a:b], last[a:b])) for a, b in zip(cut, stops)]


def _earliest(groups, ids, keys, starts):
    """Mask of the entries that are later than their group's first place."""
    order = np.lexsort((starts, keys, ids, groups))
    g = groups[order]
    head = np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1])[:len(g)], np.arange(len(g)), 0))
    first = order[head]
    later = np.zeros(len(groups), bool)
    later[order] = (ids[first] != ids[order]) | (keys[first] != keys[order]) | (starts[first] != starts[order])
    return later


def _anchors_out(hot, buckets, length, gram):
    def deal(frames):
        for ids, keys, data, ends, _, _ in _shards(frames):
            hashes, doc, first, last, _ = segments(data, ends, length, gram)
            warm = np.isin(hashes, hot)
            rows = []
            # hot anchors: every window by its digest, once per shard
            f, l, d = first[warm], last[warm], doc[warm]
            many = l - f + 1
            at = np.repeat(f - np.append(0, np.cumsum(many)[:-1])[:len(f)], many) + np.arange(many.sum())
            owner = np.repeat(d, many)
            if len(at):
                view = memoryview(np.ascontiguousarray(data))
                digest = np.frombuffer(b"".join(hashlib.blake2b(view[a:a + length], digest_size=16).digest() for a in at.tolist()), "<u8").reshape(-1, 2)
                _, group = np.unique(digest, axis=0, return_inverse=True)
                group = group.ravel()
                start = at - ends[owner]
                later = _earliest(group, ids[owner], keys[owner], start)
                for i, k, kind, body in _removed_rows(ids[owner[later]], keys[owner[later]], start[later], start[later]):
                    rows.append((k % buckets, _REMOVED, _pack(np.array([i, k])), body))
                one = np.flatnonzero(~later)
                _deal(rows, _WINDOWS, (digest[one, 0] % np.uint64(buckets)).astype(np.int64), digest[one, 0], digest[one, 1], ids[owner[one]], keys[owner[one]], start[one].astype(np.int32))
            h, d = hashes[~warm], doc[~warm]
            _deal(rows, _HASHES, (h % np.uint64(buckets)).astype(np.int64), h, ids[d], keys[d])
            yield _dealt(rows)

    return deal


def _deal(rows, kind, bucket, *arrays):
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    arrays = [a[order] for a in arrays]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    for a, b in zip(cut, np.append(cut[1:], len(bucket))):
        rows.append((int(bucket[a]), kind, None, _squeezed(_pack(*[x[a:b] for x in arrays]))))


def _told(rows):
    return _batch(rows, ["id_", "key_", "kind", "body"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()]) if rows else _batch(
        [], ["id_", "key_", "kind", "body"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()])


def _joined(table, kind, *kinds):
    parts = [_unpack(_whole(b), *kinds) for k, b in zip(table["kind"].to_pylist(), table["body"].to_pylist()) if k == kind]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _passed(table):
    return [(*_unpack(head, np.int64)[0].tolist(), _REMOVED, body) for k, head, body in zip(*(table[c].to_pylist() for c in ("kind", "head", "body"))) if k == _REMOVED]


def _anchors_in(key, table):
    """Of one bucket: repeated anchors, told to their documents, and later windows of hot anchors."""
    rows = _passed(table)
    a, b, ids, keys, start = _joined(table, _WINDOWS, np.uint64, np.uint64, np.int64, np.int64, np.int32)
    if len(a):
        _, group = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)
        later = _earliest(group.ravel(), ids, keys, start)
        rows += _removed_rows(ids[later], keys[later], start[later], start[later])
    h, ids, keys = _joined(table, _HASHES, np.uint64, np.int64, np.int64)
    order = np.argsort(h, kind="stable")
    h, ids, keys = h[order], ids[order], keys[order]
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[:-1] |= again[1:].copy()
    h, ids, keys = h[again], ids[again], keys[again]
    order = np.lexsort((keys, ids))
    h, ids, keys = h[order], ids[order], keys[order]
    cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))[:len(ids)])
    rows += [(int(ids[i]), int(keys[i]), _HASHES, np.unique(h[i:j]).tobytes()) for i, j in zip(cut, np.append(cut[1:], len(ids)))]
    return pa.Table.from_batches([_told(rows)])


def _segments_out(buckets, length, gram):
    def deal(frames):
        for ids, keys, data, ends, frame, low in _shards(frames):
            hashes, doc, first, last, _ = segments(data, ends, length, gram)
            told = frame.column(3).slice(low, len(ids)).to_pylist()
            asked = [np.frombuffer(b"".join(blobs), np.uint64) for blobs in told]
            place = np.repeat(np.arange(len(asked)), [len(a) for a in asked])
            pairs = np.unique(np.stack([place.astype(np.uint64), np.concatenate(asked)], 1), axis=0) if len(place) else np.zeros((0, 2), np.uint64)
            good = np.isin(_pair(doc.astype(np.uint64), hashes), _pair(pairs[:, 0], pairs[:, 1]))
            hashes, doc, first, last = hashes[good], doc[good], first[good], last[good]
            view, rows = data.tobytes(), []
            texts = [view[a:b] for a, b in zip(first.tolist(), (last + length).tolist())]
            start, size = first - ends[doc], last - first
            group = _numbered(texts)
            later = _earliest(group, ids[doc], keys[doc], start)
            for i, k, kind, body in _removed_rows(ids[doc[later]], keys[doc[later]], start[later], start[later] + size[later]):
                rows.append((k % buckets, _REMOVED, _pack(np.array([i, k])), body))
            one = np.flatnonzero(~later)
            bucket = (hashes[one] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            one, bucket = one[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
            for a, b in zip(cut, np.append(cut[1:], len(bucket))):
                m = one[a:b]
                head = _pack(hashes[m], ids[doc[m]], keys[doc[m]], start[m].astype(np.int32), size[m].astype(np.int32))
                rows.append((int(bucket[a]), _HASHES, _squeezed(head), _squeezed(b"".join(texts[x] for x in m.tolist()))))
            yield _dealt(rows)

    return deal


def _pair(place, hashes):
    return mix(hashes + place * np.uint64(0x9E3779B97F4A7C15))


def _numbered(texts):
    seen = {}
    return np.array([seen.setdefault(t, len(seen)) for t in texts], np.int64)


def _segments_in(length):
    def settle(key, table):
        rows, heads, texts = _passed(table), [], []
        for kind, head, body in zip(*(table[c].to_pylist() for c in ("kind", "head", "body"))):
            if kind == _HASHES:
                head, body = _whole(head), _whole(body)
                heads.append(_unpack(head, np.uint64, np.int64, np.int64, np.int32, np.int32))
                stops = np.cumsum(heads[-1][4].astype(np.int64) + length)
                texts += [body[b - n:b] for b, n in zip(stops.tolist(), (heads[-1][4] + length).tolist())]
        if texts:
            anchor, ids, keys, start, size = (np.concatenate(c) for c in zip(*heads))
            group = _numbered(texts)
            later = _earliest(group, ids, keys, start)
            rows += _removed_rows(ids[later], keys[later], start[later], start[later] + size[later])
            # one row per distinct segment; equal places are repeated rows and count once
            _, one = np.unique(np.where(later, -1, group), return_index=True)
            one = one[~later[one]]
            one = one[np.argsort(anchor[one], kind="stable")]
            a = anchor[one]
            shared = np.zeros(len(a), bool)
            shared[1:] = a[1:] == a[:-1]
            shared[:-1] |= shared[1:].copy()
            one, a = one[shared], a[shared]
            low = 0
            while low < len(one):  # whole anchors, about BATCH segments at a time
                high = int(np.searchsorted(a, a[min(low + BATCH, len(a)) - 1], side="right"))
                m = one[low:high]
                who, offset, same = repeated_windows([texts[x] for x in m.tolist()], length)
                m = m[who]
                at = start[m] + offset
                late = _earliest(same, ids[m], keys[m], at)
                rows += _removed_rows(ids[m[late]], keys[m[late]], at[late], at[late])
                low = high
        return pa.Table.from_batches([_told(rows)])

    return settle


def repeated(documents: DataFrame, length=LENGTH, gram=GRAM, doc_id="doc_id", text="text", keep=None) -> DataFrame:
    """Kept columns plus n_bytes, n_removed, removed (byte ranges: start, stop), kept_text (binary: the remaining bytes)."""
    taken = {"n_bytes", "n_removed", "removed", "kept_text"}
    names = [c for c in (documents.columns if keep is None else keep) if c.lower() not in taken]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = documents.select(F.struct(*[documents[c] for c in names]).alias("row_"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("id_"), F.xxhash64(F.col(doc_id), body).alias("key_"), body.alias("text_"))
    slim = docs.select("id_", "key_", "text_")
    count, size = documents.select(F.count("*"), F.sum(F.octet_length(text))).first()
    buckets = max(64, -(-(size or 0) // BUCKET_BYTES))
    hot = _hot(slim, min(1.0, SAMPLE / max(count, 1)), length, gram)
    slim_wide = slim.filter(F.octet_length("text_") >= length)
    told = slim_wide.mapInArrow(_anchors_out(hot, buckets, length, gram), _DEALT).groupBy("bucket").applyInArrow(_anchors_in, _TOLD)
    told = stored(told)
    asked = told.filter(F.col("kind") == _HASHES).groupBy("id_", "key_").agg(F.collect_list("body").alias("asked"))
    wanted = slim_wide.join(asked, ["id_", "key_"]).select("id_", "key_", "text_", "asked")
    settled = wanted.mapInArrow(_segments_out(buckets, length, gram), _DEALT).groupBy("bucket").applyInArrow(_segments_in(length), _TOLD)
    removed = told.filter(F.col("kind") == _REMOVED).unionByName(settled).groupBy("id_", "key_").agg(F.collect_list("body").alias("ranges_"))
    copy = F.row_number().over(Window.partitionBy("id_", "key_").orderBy(F.lit(0)))
    out = docs.join(removed, ["id_", "key_"], "left").withColumn("copy_", copy)
    return _cut(out, names, length)


def _hot(slim, share, length, gram):
    """Anchors of HOT_DOCUMENTS or more sampled documents: at most one in HOT_DOCUMENTS of the sample's anchors."""

    def anchors(frames):
        for _, _, data, ends, _, _ in _shards(frames):
            hashes, doc, *_ = segments(data, ends, length, gram)
            pairs = np.unique(np.stack([doc.astype(np.uint64), hashes], 1), axis=0)
            kinds, n = np.unique(pairs[:, 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

    met = slim.sample(share, 5).mapInArrow(anchors, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return np.array([r[0] for r in met.filter(F.col("n") >= HOT_DOCUMENTS).select("hash").collect()], np.int64).astype(np.uint64)


def _cut(out, names, length):
    schema = out.select(*[F.col("row_")[c].alias(c) for c in names]).schema
    added = StructType.fromDDL("n_bytes long, n_removed long, removed array<struct<start:int,stop:int>>, kept_text binary")
    schema = StructType([*schema.fields, *added.fields])

    def cut(frames):
        for frame in frames:
            told, copies = frame.column(1).to_pylist(), frame.column(2).to_pylist()
            sizes, gone, spans, kept = [], [], [], []
            for text, ranges, copy in zip(frame.column(0).cast(pa.large_binary()), told, copies):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                steps = np.zeros(len(data) + 1, np.int32)
                if copy > 1 and len(data) >= length:
                    ranges = [_pack(np.array([0], np.int32), np.array([len(data) - length], np.int32))]
                for blob in ranges or ():
                    first, last = _unpack(blob, np.int32, np.int32)
                    np.add.at(steps, first, 1)
                    np.add.at(steps, last + length, -1)
                hit = np.cumsum(steps)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
                sizes.append(len(data))
                gone.append(int(hit.sum()))
                spans.append([{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
                kept.append(data[~hit].tobytes())
            rest = [frame.column(3 + i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, schema_spans), pa.array(kept, pa.binary())], names=schema.names)

    schema_spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return out.select("text_", "ranges_", "copy_", *[F.col("row_")[c].alias(c) for c in names]).mapInArrow(cut, schema)
