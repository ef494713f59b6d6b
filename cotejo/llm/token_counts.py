"""Token counts of whole texts with a whole-token shortcut.

Offline, once per vocabulary: (a) ``proven boundary``: no piece has the word mark after another character, so no merge
can cross from a word into the next mark and the text falls into pre-tokens ``mark+ non-mark*`` that are encoded apart;
(b) ``whole tokens``: the pieces which the library encodes, alone, as just themselves. At run time a pre-token that is
a whole token counts 1 with one look-up; only the rest is merged by the library, and each distinct rest once per
worker while a bounded table holds it. The proven set is broadcast: its size is the vocabulary's.

A model without property (a), or one that rewrites its input, is refused. Null and empty texts have no tokens; nothing
is truncated, and no begin or end token is counted.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import map_texts

MARK = "▁"
REMEMBERED = 1 << 18
_LOOSE = re.compile(r" +[^ ]*")
_models = {}


def load(model):
    """The library's processor for a model file, once per process."""
    if model not in _models:
        from sentencepiece import SentencePieceProcessor

        _models[model] = SentencePieceProcessor(model_file=model)
    return _models[model]


def whole_tokens(model) -> frozenset:
    """The words (without their mark) that are proven to be one token; raises where words are not encoded apart."""
    library = load(model)
    pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces) or "".join(library.encode(" a  b ", out_type=str)) != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
        raise ValueError(f"{model}: words of this vocabulary are not encoded apart")
    words = [(i, p[1:]) for i, p in enumerate(pieces) if p[:1] == MARK and len(p) > 1 and MARK not in p[1:]]
    encoded = library.encode([w for _, w in words], num_threads=1)
    return frozenset(w for (i, w), ids in zip(words, encoded) if ids == [i])


class _Counts(dict):
    """Tokens of a pre-token without its first mark."""

    def __init__(self, library, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.library, self.whole = library, whole
        self[""] = len(library.encode("x ")) - len(library.encode("x"))  # a mark with nothing behind it

    def __missing__(self, rest):
        n = len(self.library.encode(rest))
        if len(self) < len(self.whole) + REMEMBERED:
            self[rest] = n
        return n

    def of(self, text):
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self[p[1:]] for p in _LOOSE.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))


def token_counts(documents: DataFrame, model, limit=4096, text="text", keep=None) -> DataFrame:
    """Kept columns plus n_bytes, n_tokens, over_limit."""
    whole = documents.sparkSession.sparkContext.broadcast(whole_tokens(model))

    def count(texts):
        counts = _counts(model, whole)
        tokens = [counts.of(t) for t in texts.to_pylist()]
        return [pa.array(tokens, pa.int64())]

    out = map_texts(documents.withColumn("__bytes", F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")),
                    count, [("n_tokens", "long")], text, [*(documents.columns if keep is None else keep), "__bytes"])
    out = out.drop("n_bytes", "over_limit").withColumnRenamed("__bytes", "n_bytes")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _counts(model, whole):
    key = (model, "counts")
    if key not in _models:
        _models[key] = _Counts(load(model), whole.value)
    return _models[key]
