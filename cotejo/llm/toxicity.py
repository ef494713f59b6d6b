"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals make the document's score.

Two tags (clean, toxic). A token's score for ``toxic`` is a sum of weights of hashed features (the word, its stem's
first letters, the words beside it); two by two transition weights link neighbours. Token labels come from documents
labelled toxic or not: in a toxic document, words found far more often in toxic documents than in clean ones are
labelled toxic, every other token clean. The field is fitted by AdaGrad on the likelihood, then a logistic layer over
the marginals (their sum, largest and mean) is fitted to the labels of documents the field has not seen.

How many documents hold a word is counted over all labelled rows (``vocabulary``), so rare words and small languages
are met. The field's fit uses at most ``sample`` documents of each label (smallest id hashes), with whole texts: the one
bound here, a documented parameter. Words of the vocabulary that the sample lacks get the middle weight of those it has. Scoring covers every whole text; forward and backward passes run over all tokens of a shard at
once, as scans of 2x2 matrices in blocks, with the chain cut at document ends.

Null and empty texts score as documents without tokens (the logistic layer's value at zero). Labelled rows with a null
id or label are not learnt from; labels that disagree about one id both count. Without labels of both kinds, the model
scores every document with the share of toxic labels (0.5 without any).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import SHARD_BYTES, Words, chain, cuts, map_texts, mix, stored

SAMPLE = 700
BITS = 18
STEM = 4
ROUNDS = 30
THRESHOLD = 0.7
LIFT, PROOF = 6.0, 20.0
_STRIDE = 64
_SCALES = np.array([1.0, 1.0, 0.2, 0.2])  # what stands beside a word says less
_SPANS = "array<struct<start:int,stop:int>>"


def labelled(documents: DataFrame, labels: DataFrame, sample=SAMPLE, doc_id="doc_id", label="toxic", text="text"):
    """(texts, labels) of at most ``sample`` labelled documents of each kind, the smallest id hashes first."""
    ids = labels.select(F.col(doc_id).alias("id_"), (F.col(label) == 1).alias("label_")).dropna()
    picked = None
    for kind in (True, False):
        some = ids.filter(F.col("label_") == kind).orderBy(F.xxhash64("id_", F.lit(11)), "id_").limit(sample)
        picked = some if picked is None else picked.unionByName(some)
    rows = documents.select(F.col(doc_id).alias("id_"), F.col(text).cast("string").alias("text_"))
    rows = rows.join(F.broadcast(picked), "id_")  # 2 x sample ids
    got = sorted((r["label_"], r["id_"], r["text_"] or "") for r in rows.collect())
    return [t for _, _, t in got], np.array([y for y, _, _ in got], bool)


def _stems(w: Words, words):
    """The first STEM bytes of longer words, the hash of shorter ones."""
    out = words.copy()
    long = w.stops - w.starts > STEM
    letters = np.zeros(long.sum(), np.uint64)
    for k in range(STEM):
        letters = (letters << np.uint64(8)) | w.data[w.starts[long] + k]
    out[long] = letters
    return out


def _features(w: Words):
    """Feature slots of each token: word, first letters, word before, word behind (0 past the document's ends)."""
    words = w.hashes()
    doc = w.doc()
    before, behind = np.zeros_like(words), np.zeros_like(words)
    same = doc[1:] == doc[:-1]
    before[1:][same], behind[:-1][same] = words[:-1][same], words[1:][same]
    short = _stems(w, words)
    mask = np.uint64((1 << BITS) - 1)
    kinds = [np.full_like(words, k) for k in range(4)]
    return np.stack([(chain([k, x]) & mask).astype(np.int64) for k, x in zip(kinds, (words, short, before, behind))])


@dataclass
class Field:
    weights: np.ndarray  # hashed feature weights for the toxic tag
    bias: float
    links: np.ndarray  # 2 x 2
    layer: np.ndarray  # logistic weights over document statistics

    def potentials(self, slots, first):
        """2x2 matrix of each token: from the tag before to its own; the first of a document forgets what came before."""
        score = _SCALES @ self.weights[slots] + self.bias
        tag = np.stack([np.exp(-np.clip(score, 0, 50)), np.exp(np.clip(score, -50, 0))])
        link = np.exp(self.links)
        m = np.stack([link[0, 0] * tag[0], link[0, 1] * tag[1], link[1, 0] * tag[0], link[1, 1] * tag[1]])
        m[:, first] = np.stack([tag[0], tag[1], tag[0], tag[1]])[:, first]
        return m

    def marginals(self, slots, w: Words, pairs=False):
        """P(toxic) of each token; with ``pairs`` also the expected count of each of the four links."""
        n = slots.shape[1]
        if not n:
            return (np.zeros(0), np.zeros((2, 2))) if pairs else np.zeros(0)
        opens = np.zeros(n, bool)
        opens[w.first[:-1][w.counts > 0]] = True
        m = self.potentials(slots, opens)
        ahead = forward(m)
        turned = np.ones_like(m)
        turned[:, 1:] = m[:, :0:-1][[0, 2, 1, 3]]
        back = forward(turned)[:, ::-1]
        both = ahead * back
        toxic = both[1] / both.sum(0)
        if not pairs:
            return toxic
        inner = np.flatnonzero(~opens)
        joint = np.stack([ahead[i, inner - 1] * m[2 * i + j, inner] * back[j, inner] for i in (0, 1) for j in (0, 1)])
        return toxic, (joint / joint.sum(0)).sum(1).reshape(2, 2)


def forward(m):
    """Normalised row vectors after each step of a chain of 2x2 matrices (rows 00, 01, 10, 11), from (1/2, 1/2)."""
    n = m.shape[1]
    if n <= 2 * _STRIDE:
        out, a, b = np.empty((2, n)), 0.5, 0.5
        for k, (m00, m01, m10, m11) in enumerate(m.T.tolist()):
            a, b = a * m00 + b * m10, a * m01 + b * m11
            a, b = a / (a + b), b / (a + b)
            out[0, k], out[1, k] = a, b
        return out
    blocks = -(-n // _STRIDE)
    padded = np.ones((4, blocks * _STRIDE))
    padded[:, :n] = m
    padded = np.ascontiguousarray(padded.reshape(4, blocks, _STRIDE).transpose(2, 0, 1))
    p = padded[0].copy()
    for q in padded[1:]:
        p = np.stack([p[0] * q[0] + p[1] * q[2], p[0] * q[1] + p[1] * q[3], p[2] * q[0] + p[3] * q[2], p[2] * q[1] + p[3] * q[3]])
        p /= p.sum(0)
    starts = np.full((2, blocks), 0.5)
    starts[:, 1:] = forward(p)[:, :-1]
    out, (a, b) = np.empty((_STRIDE, 2, blocks)), starts
    for k, q in enumerate(padded):
        a, b = a * q[0] + b * q[2], a * q[1] + b * q[3]
        total = a + b
        out[k, 0], out[k, 1] = a / total, b / total
        a, b = out[k, 0], out[k, 1]
    return out.transpose(1, 2, 0).reshape(2, -1)[:, :n]


def vocabulary(documents: DataFrame, labels: DataFrame, lift=LIFT, proof=PROOF, doc_id="doc_id", label="toxic", text="text"):
    """(words, stems): sorted hashes of those that ``toxic_tokens`` would take, counted over all labelled rows."""
    ids = labels.select(F.col(doc_id).alias("id_"), (F.col(label) == 1).alias("label_")).dropna()
    ids = ids.hint("merge")  # all labels: too many to broadcast in a large corpus, so the plan is the same at every size
    rows = documents.select(F.col(doc_id).alias("id_"), F.col(text).cast("string").alias("text_")).join(ids, "id_").select("label_", "text_")

    def counts(frames):
        for frame in frames:
            toxic, column = np.array(frame.column(0).to_pylist(), bool), frame.column(1).cast(pa.large_string())
            for low, high in cuts(column, SHARD_BYTES):
                w, own = Words(column.slice(low, high - low), alnum=True), toxic[low:high]
                words, doc = w.hashes(), w.doc()
                parts = [(k, *_held(x, doc, own)[:3]) for k, x in enumerate((words, _stems(w, words)))]
                parts.append((2, np.zeros(1, np.uint64), np.array([own.sum()]), np.array([(~own).sum()])))  # documents
                for kind, types, bad, good in parts:
                    values = [pa.array(np.full(len(types), kind), pa.int32()), pa.array(types.view(np.int64)), pa.array(bad, pa.int64()), pa.array(good, pa.int64())]
                    yield pa.RecordBatch.from_arrays(values, names=["kind", "type", "bad", "good"])

    held = rows.mapInArrow(counts, "kind int, type long, bad long, good long")
    held = stored(held.groupBy("kind", "type").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    total = held.filter("kind = 2").select("bad", "good").first()
    if not total or not total[0] or not total[1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    share = total[0] / (total[0] + total[1])
    both = F.col("bad") + F.col("good")
    odds = ((F.col("bad") + 0.5) / (total[0] + 1)) / ((F.col("good") + 0.5) / (total[1] + 1))
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * p))).otherwise(0.0)
    taken = held.filter("kind < 2").filter((odds >= lift) & (2 * (part("bad", share) + part("good", 1 - share)) >= proof))
    got = taken.select("kind", "type").toPandas()  # the toxic words only
    return tuple(np.sort(got["type"][got["kind"] == k].to_numpy(np.int64).view(np.uint64)) for k in (0, 1))


def _held(words, doc, labels):
    """Types, the number of toxic and of clean documents that hold each, and each token's type."""
    kinds, place = np.unique(words, return_inverse=True)
    pairs = np.unique(np.stack([place, doc], 1), axis=0)
    of = labels[pairs[:, 1]]
    return kinds, *(np.bincount(pairs[x, 0], minlength=len(kinds)) for x in (of, ~of)), place


def toxic_tokens(words, doc, labels, lift=LIFT, proof=PROOF):
    """Which tokens have a word (or first letters) that toxic documents hold far more often than clean ones: by ``lift``,
    and with a likelihood ratio of at least ``proof``, so that rare words do not qualify by chance."""
    _, bad, good, place = _held(words, doc, labels)
    bad, good = bad.astype(float), good.astype(float)
    share = labels.mean()
    odds = ((bad + 0.5) / (labels.sum() + 1)) / ((good + 0.5) / ((~labels).sum() + 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(bad > 0, bad * np.log(bad / ((bad + good) * share)), 0) + np.where(good > 0, good * np.log(good / ((bad + good) * (1 - share))), 0))
    return ((odds >= lift) & (ratio >= proof))[place]


def train(texts, labels, rounds=ROUNDS, known=None) -> Field:
    """A field from labelled texts; ``known``: the ``vocabulary`` of all labelled rows, else that of the texts."""
    share = float(labels.mean()) if len(labels) else 0.5
    field = Field(np.zeros(1 << BITS), 0.0, np.zeros((2, 2)), np.zeros(4))
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 0.001), 0.999)
        field.layer[0] = np.log(share / (1 - share))
        return field
    own = mix(np.arange(len(texts), dtype=np.uint64)) % np.uint64(3) > 0  # the field sees two thirds; the layer is fitted to what it says of the rest
    told, layer_labels = [t for t, o in zip(texts, own) if not o], labels[~own]
    texts, labels = [t for t, o in zip(texts, own) if o], labels[own]
    w = Words(pa.array(texts, pa.large_string()), alnum=True)
    words, doc, slots = w.hashes(), w.doc(), _features(w)
    types = words, _stems(w, words)
    marked = [toxic_tokens(x, doc, labels) if known is None else np.isin(x, known[k]) for k, x in enumerate(types)]
    gold = (marked[0] | marked[1]) & labels[doc]
    opens = np.zeros(len(words), bool)
    opens[w.first[:-1][w.counts > 0]] = True
    inner = np.flatnonzero(~opens)
    links = np.zeros((2, 2))
    np.add.at(links, (gold[inner - 1].astype(int), gold[inner].astype(int)), 1)
    field.bias, size = -3.0, max(1, gold.sum())
    seen, seen_links = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(rounds):
        toxic, expected = field.marginals(slots, w, pairs=True)
        miss = gold - toxic
        slope = sum(k * np.bincount(s, weights=miss, minlength=1 << BITS) for k, s in zip(_SCALES, slots)) - 1e-3 * field.weights
        seen += slope**2
        field.weights += 0.5 * slope / np.sqrt(seen)
        slope = (links - expected) / size
        seen_links += slope**2
        field.links += 0.2 * slope / np.sqrt(seen_links)
    if known is not None and gold.any():
        middle = np.median(field.weights[slots[:2, gold]].sum(0))
        for kind in (0, 1):
            new = np.setdiff1d(known[kind], types[kind])
            new = (chain([np.full_like(new, kind), new]) & np.uint64((1 << BITS) - 1)).astype(np.int64)
            field.weights[new] = np.maximum(field.weights[new], middle)
    w = Words(pa.array(told, pa.large_string()), alnum=True)
    x = _statistics(field.marginals(_features(w), w), w)
    y, layer = layer_labels.astype(float), np.zeros(4)
    for _ in range(25):  # Newton steps of a ridged logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ layer, -40, 40)))
        slope = x.T @ (y - p) - 0.1 * layer
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(4)
        layer = layer + np.clip(np.linalg.solve(curve, slope), -4, 4)
    field.layer = layer
    return field


def _statistics(toxic, w: Words):
    """Per document: 1, log of the expected number of toxic tokens, largest marginal, root of the mean marginal."""
    sums = np.append(0, np.cumsum(toxic))
    total = sums[w.first[1:]] - sums[w.first[:-1]]
    top = np.zeros(len(w.counts))
    some = w.counts > 0
    if some.any():
        top[some] = np.maximum.reduceat(toxic, w.first[:-1][some])
    return np.stack([np.ones(len(top)), np.log1p(np.maximum(total, 0)), top, np.sqrt(np.maximum(total, 0) / np.maximum(w.counts, 1))], 1)


def toxicity(documents: DataFrame, field: Field, threshold=THRESHOLD, text="text", keep=None) -> DataFrame:
    """Kept columns plus score, predicted, and spans: code point ranges of tokens more likely toxic than not, runs merged."""
    model = documents.sparkSession.sparkContext.broadcast(field)  # 2^BITS weights

    def score(texts):
        field, w = model.value, Words(texts, alnum=True)
        toxic = field.marginals(_features(w), w)
        value = 1 / (1 + np.exp(-np.clip(_statistics(toxic, w) @ field.layer, -40, 40)))
        value = np.round(value, 9)
        bad = toxic > 0.5
        doc = w.doc()
        same = np.append(False, doc[1:] == doc[:-1])
        start = np.flatnonzero(bad & ~(np.append(False, bad[:-1]) & same))
        stop = np.flatnonzero(bad & ~(np.append(bad[1:], False) & np.append(same[1:], False)))
        point = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
        base = point[w.ends[doc[start]]]
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(start, w.first), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(point[w.starts[start]] - base, pa.int32()), pa.array(point[w.stops[stop]] - base, pa.int32())], ["start", "stop"]
            ),
        )
        return [pa.array(value), pa.array((value >= threshold).astype(np.int32)), spans]

    return map_texts(documents, score, [("score", "double"), ("predicted", "int"), ("spans", _SPANS)], text, keep)
