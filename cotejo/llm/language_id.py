"""Language identification with a blended-spectrum string kernel, Nystrom landmarks and kernel ridge regression.

A text's presence vector marks which byte n-grams (``ORDERS``, A-Z lower-cased) occur in it, hashed to 2^BITS slots.
The kernel of two texts is the number of shared slots over the geometric mean of their numbers. Landmark texts span the
Nystrom map; one ridge regression per language (one versus rest) is solved in that space. The landmark matrix, the map
and the ridge weights are multiplied once, so a batch of texts is scored by one product with its presence matrix.

Fitting uses at most ``sample`` documents of each language (smallest id hashes): a documented bound. Scoring covers
every whole text. A text that is null or has no letter gets ``und`` with score 0. Ties go to the language first by
name. Without any labelled row every text is ``und``. Null ids pass through; rows with a null language teach nothing.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotejo.llm.common import _LOWER, map_texts, mix, raw

ORDERS = (1, 2, 3, 4)
BITS = 15
SAMPLE = 250
LANDMARKS = 160
RIDGE = 1e-2
_ROWS = 128


def labelled(documents: DataFrame, sample=SAMPLE, doc_id="doc_id", text="text", lang="lang"):
    """(texts, languages): at most ``sample`` rows of each language, the smallest id hashes first."""
    rows = documents.select(F.col(doc_id).alias("id_"), F.col(lang).cast("string").alias("lang_")).filter("lang_ IS NOT NULL AND id_ IS NOT NULL")
    order = Window.partitionBy("lang_").orderBy(F.xxhash64("id_", F.lit(7)), "id_")
    ids = rows.withColumn("n_", F.row_number().over(order)).filter(F.col("n_") <= sample).select("id_", "lang_").distinct()
    texts = documents.select(F.col(doc_id).alias("id_"), F.col(text).cast("string").alias("text_"))
    got = texts.join(F.broadcast(ids), "id_").collect()  # languages x sample ids
    got = sorted((r["lang_"], r["id_"], r["text_"] or "") for r in got)
    return [t for _, _, t in got], [g for g, _, _ in got]


def presence(texts):
    """0/1 matrix: which n-gram slots occur in each text."""
    data, ends = raw(texts)
    data = _LOWER[data].astype(np.uint64)
    out = np.zeros((len(texts), 1 << BITS), np.uint8)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) << BITS, np.diff(ends))
    stop = np.repeat(ends[1:], np.diff(ends))
    gram = np.zeros(len(data), np.uint64)
    at = np.arange(len(data))
    for n in range(1, max(ORDERS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        gram = (gram[:size] << np.uint64(8)) | data[n - 1:]
        if n in ORDERS:
            inside = at[:size] + n <= stop[:size]
            slot = (mix(gram + np.uint64(n << 40)) >> np.uint64(64 - BITS)).astype(np.int64)
            flat[(row[:size] + slot)[inside]] = 1
    return out


class Classifier:
    """Languages, and the matrix that turns a normalised presence row into one score per language."""

    def __init__(self, names, matrix):
        self.names, self.matrix = names, matrix

    def scores(self, texts):
        x = presence(texts).astype(np.float32)
        size = np.sqrt(np.maximum(x.sum(1), 1))
        return (x @ self.matrix) / size[:, None]


def train(texts, languages, landmarks=LANDMARKS, ridge=RIDGE) -> Classifier:
    names = sorted(set(languages))
    if not names:
        return Classifier([], np.zeros((1 << BITS, 0), np.float32))
    x = np.concatenate([presence(pa.array(texts[i:i + _ROWS], pa.large_string())) for i in range(0, len(texts), _ROWS)]).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1), 1))[:, None]
    order = np.argsort(mix(np.arange(len(texts), dtype=np.uint64)))
    marks = x[np.sort(order[:landmarks])]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-8 * values.max()
    to_map = vectors[:, good] / np.sqrt(values[good])
    mapped = (x @ marks.T).astype(np.float64) @ to_map
    goal = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weights = np.linalg.solve(mapped.T @ mapped + ridge * len(texts) * np.eye(mapped.shape[1]), mapped.T @ goal)
    return Classifier(names, (marks.T.astype(np.float64) @ to_map @ weights).astype(np.float32))


def identified(documents: DataFrame, classifier: Classifier, text="text", keep=None) -> DataFrame:
    """Kept columns plus lang_pred and score (0 to 1: half the ridge value plus a half, cut to the range)."""
    model = documents.sparkSession.sparkContext.broadcast(classifier)  # 2^BITS x languages

    def predict(texts):
        c, best, value = model.value, [], []
        for low in range(0, len(texts), _ROWS):
            part = texts.slice(low, _ROWS)
            told = [t is not None and any(map(str.isalpha, t)) for t in part.to_pylist()]
            if not c.names:
                best += ["und"] * len(told)
                value += [0.0] * len(told)
                continue
            scores = np.round(c.scores(part).astype(np.float64), 6)
            top = scores.argmax(1)
            sure = np.clip((scores[np.arange(len(top)), top] + 1) / 2, 0, 1)
            best += [c.names[k] if t else "und" for k, t in zip(top, told)]
            value += [s if t else 0.0 for s, t in zip(sure.tolist(), told)]
        return [pa.array(best, pa.string()), pa.array(value, pa.float64())]

    return map_texts(documents, predict, [("lang_pred", "string"), ("score", "double")], text, keep)
