"""Quality rules: a decision list learnt by sequential covering, as ordered Spark conditional expressions.

Everything per document is built-in column functions. ``statistics`` measures whole texts. ``learnt_rules`` counts the
labelled documents per cell of binned statistics (one aggregation; the cut points are percentiles of the good
documents, so the table of cells is bounded by ``(cuts + 1) ** features``) and covers the bad ones rule by rule on those
counts: a rule grows by the threshold with the best information gain on the growing part of the labels, is pruned from
the back on the other part, and joins the list while it is precise enough there. A rule has at most ``MOST_LITERALS``
thresholds and the list at most ``MOST_RULES`` rules, so that it stays readable. ``verdict`` is the list as one
conditional expression: the first rule that holds names the reason, none means the document is kept.

Words are what lies between spaces and the characters from tab to carriage return. A null text counts as empty. Labels
that are null or whose id is null are not learnt from; repeated labels count each time. Without bad labels there are no
rules. Documents are never joined to their labels but by the small statistics table.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SPLIT = r"[\x20\x09-\x0D]+"
CUTS = (0.01, 0.05, 0.5, 0.95, 0.99)
PRECISION = 0.9
MOST_RULES, MOST_LITERALS = 12, 4
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_kinds")
FEATURES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "kinds": "n_kinds / sqrt(greatest(n_words, 1))",
    "length": "word_chars / greatest(n_words, 1)",
}


def statistics(documents: DataFrame, text="text", keep=None) -> DataFrame:
    """Kept columns (all by default; statistics replace equal names) plus STATISTICS of every whole text."""
    taken = {s.lower() for s in STATISTICS}
    kept = [c for c in (documents.columns if keep is None else keep) if c.lower() not in taken]
    out = documents.select(*[documents[c] for c in kept], F.coalesce(documents[text].cast("string"), F.lit("")).alias("t_"))
    bare = F.btrim("t_", F.lit(SPACES))
    out = out.withColumn("words_", F.when(F.length(bare) > 0, F.split(bare, _SPLIT)).otherwise(F.array().cast("array<string>")))
    grams = F.expr("transform(sequence(0, size(words_) - 3), i -> xxhash64(words_[i], words_[i + 1], words_[i + 2]))")
    lines = F.filter(F.split("t_", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    out = out.withColumns({"grams_": F.when(F.size("words_") >= 3, grams), "lines_": lines})
    # only texts in which some window comes back are sorted
    again = F.size(F.array_distinct("grams_")) < F.size("grams_")
    out = out.withColumn("order_", F.when(again, F.array_sort(F.transform("grams_", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    twin = F.expr("transform(filter(order_, (x, k) -> x.g <=> get(order_, k - 1).g OR x.g <=> get(order_, k + 1).g), x -> x.i)")
    out = out.withColumn("twins_", F.array_sort(twin))
    covered = F.expr(
        "aggregate(twins_, named_struct('n', 0L, 'p', -3), (a, p) -> named_struct('n', a.n + least(3, p - a.p), 'p', p), a -> a.n)"
    )
    return out.select(
        *kept,
        F.size("words_").cast("long").alias("n_words"),
        F.length(F.translate("t_", SPACES, "")).cast("long").alias("word_chars"),
        _count("t_", SYMBOLS).alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        _count("t_", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        _count("t_", "!?").alias("n_marks"),
        F.size(F.array_distinct("words_")).cast("long").alias("n_kinds"),
    )


def _count(column, chars):
    return (F.length(column) - F.length(F.translate(column, chars, ""))).cast("long")


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    bound: float

    def column(self):
        value = F.expr(FEATURES[self.feature])
        return value > self.bound if self.above else value <= self.bound


def learnt_rules(measured: DataFrame, labels: DataFrame, doc_id="doc_id", label="quality", precision=PRECISION) -> list:
    """Ordered rules (tuples of literals) that tell bad documents, learnt from every labelled one."""
    known = labels.select(F.col(doc_id).alias("id_"), (F.col(label) == 1).alias("good_")).dropna()
    values = measured.select(F.col(doc_id).alias("id_"), *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    known = stored(values.join(known, "id_"))
    cuts = known.filter("good_").agg(*[F.percentile_approx(f, list(CUTS), 10000).alias(f) for f in FEATURES]).first().asDict()
    cuts = {f: sorted(set(c)) for f, c in cuts.items() if c}
    if not cuts:
        return []
    bins = [sum((F.col(f) > c).cast("int") for c in cuts[f]).alias(f) for f in cuts]
    part = (F.pmod(F.xxhash64("id_", F.lit(3)), F.lit(3)) > 0).alias("grow_")
    cells = known.groupBy(*bins, part).agg(F.count_if(~F.col("good_")).alias("bad"), F.count_if("good_").alias("good")).collect()
    cells = sorted((tuple(r[f] for f in cuts), r["grow_"], r["bad"], r["good"]) for r in cells)
    names = list(cuts)
    rules = [
        tuple(Literal(names[k], above, cuts[names[k]][c]) for k, above, c in rule)
        for rule in _covering(cells, [len(cuts[n]) for n in names], precision)
    ]
    return _centred(known, rules)


def _centred(known: DataFrame, rules) -> list:
    """The rules with each bound moved halfway to the nearest of the bad documents that its rule covers (all but 2 %)."""
    edges = []
    for rule in rules:
        covered = ~F.col("good_")
        for one in rule:
            covered = covered & (F.col(one.feature) > one.bound if one.above else F.col(one.feature) <= one.bound)
        edges += [F.percentile_approx(F.when(covered, F.col(one.feature)), 0.02 if one.above else 0.98, 10000) for one in rule]
    if not edges:
        return rules
    edges = iter(known.agg(*[e.alias(f"e{k}") for k, e in enumerate(edges)]).first())
    return [tuple(Literal(one.feature, one.above, (one.bound + next(edges)) / 2) for one in rule) for rule in rules]


def _covering(cells, sizes, precision):
    """Rules as tuples of (feature, above, cut): grown, pruned, and taken until one is not precise on the pruning part.

    ``cells`` are (bins, growing part, bad, good). What all literals cover comes from one histogram for each feature.
    """
    bins = np.array([c[0] for c in cells], np.int64).reshape(len(cells), len(sizes))
    grow = np.array([c[1] for c in cells], bool)
    counts = np.array([c[2:] for c in cells], np.float64).reshape(len(cells), 2)
    literals = [(k, above, c) for k, n in enumerate(sizes) for c in range(n) for above in (True, False)]

    def holds(one):
        k, above, c = one
        return (bins[:, k] > c) == above

    def covered(rows):
        return counts[rows].sum(0)

    def each(rows):  # (bad, good) of every literal, in their order
        out = []
        for k, n in enumerate(sizes):
            upto = np.stack([np.cumsum(np.bincount(bins[rows, k], counts[rows, j], n + 1)) for j in (0, 1)], 1)
            out.append(np.stack([upto[-1] - upto[:n], upto[:n]], 1).reshape(2 * n, 2))
        return np.concatenate(out)

    left, rules = np.ones(len(cells), bool), []
    while len(rules) < MOST_RULES:
        rule, inside = (), left & grow
        bad, good = covered(inside)
        while good and bad and len(rule) < MOST_LITERALS:
            told = each(inside)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = told[:, 0] * (np.log2(told[:, 0] / told.sum(1)) - math.log2(bad / (bad + good)))
            gain = np.where(told[:, 0] > 0, gain, 0.0)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9:
                break
            rule, inside, (bad, good) = (*rule, literals[best]), inside & holds(literals[best]), told[best]
        worth, inside = [], left & ~grow
        for n, one in enumerate(rule, 1):
            inside = inside & holds(one)
            b, g = covered(inside)
            worth.append(((b - g) / max(b + g, 1), -n, b, g))
        if not worth:
            break
        _, n, b, g = max(worth)
        if b < 3 or b < precision * (b + g):
            break
        rules.append(rule[:-n])  # n is minus the length
        for one in rules[-1]:
            inside = holds(one) if one is rules[-1][0] else inside & holds(one)
        left &= ~inside
    return rules


def verdict(rules):
    """The decision list: the number of the first rule that holds, null where the document is kept."""
    out = None
    for n, rule in enumerate(rules, 1):
        both = F.lit(True)
        for one in rule:
            both = both & one.column()
        out = F.when(both, n) if out is None else out.when(both, n)
    return F.lit(None).cast("int") if out is None else out


def judged(measured: DataFrame, rules) -> DataFrame:
    """Measured documents plus base_failed, rule and kept."""
    out = measured.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def kept_documents(documents: DataFrame, labels: DataFrame, text="text", doc_id="doc_id") -> DataFrame:
    """The documents that pass, with their own columns."""
    packed = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row_"), documents[text].alias("text_"))
    measured = stored(statistics(packed, "text_", ["row_"]))
    rules = learnt_rules(measured.select(F.col("row_")[doc_id].alias(doc_id), *STATISTICS), labels, doc_id)
    return judged(measured, rules).filter("kept").select("row_.*")
