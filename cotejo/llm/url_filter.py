"""URL filter: rules first, then naive Bayes over segmented host words and path tokens.

``Rule``s fit a host and its subdomains where the path starts with theirs; the longest fitting rule decides. Every
other URL is scored: each label of a host is split into words by a Viterbi search over unigram probabilities counted on
the pages' own visible text, path tokens are added (numbers as ``#``), and multinomial naive Bayes, trained on the URLs
that rules decide and on a few seed words, says ``block`` or ``allow``.

What the rules look at must not come back as evidence. Labels that any rule's host names and as many leading path
segments as the longest rule path has are no tokens, neither in training nor in scoring. The pages below one rule host
(the longest that fits) form a zone, and both verdicts weigh the same in it: a zone with a single verdict teaches
nothing, as all its words would only repeat the rule. A host counts once, however many pages it has. The prior is a
stated share of bad pages (``prior``), not the rules' share.

Two views teach each other. Hosts that hold a seed word are the first bad ones. A word that hosts show tells when at
least ``SUPPORT`` bad hosts show it and they are ``PURITY`` of all that do, and ``LIFT`` times their share of all hosts; a
host is bad by its pages when at least ``TELLING_KINDS`` such words make up ``TELLING_SHARE`` of what it shows. New bad
hosts make more words tell, for ``ROUNDS`` rounds. In the end every host that shows a word teaches its URL tokens to the class it is in, and
the prior is the share of bad hosts, with the stated prior as ``PRIOR_HOSTS`` hosts besides. The pages' words never score a
page: a URL is judged by its own tokens alone. With fewer than ``SUPPORT`` hosts that hold a seed word no word can tell,
and their words are not counted.

``seeds`` is the caller's list of host words, each with its plural in s; the short default is general and not drawn from
any table. Words that neither the seeds nor the ruled pages tell about say nothing.

Nothing here is broadcast: distinct host labels meet the unigram counts through their substrings, and tokens meet the
class counts, in joins that the engine splits where a key is hot. Segmentation runs once per distinct label and scores
once per distinct (host, path); pages are joined back on both.

Null URLs and those without ``://`` have an empty host and path: no rule fits, and the prior decides. Repeated
pages get equal verdicts; null ids pass through; labels of any length are split, in time that grows with their length; columns other than the id are not carried. With no page at all, or none
that a rule decides, the seeds and the prior decide.
"""

import math
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import stored

LONGEST_WORD = 63  # longer stretches are split: no label of a registered host name is longer
LABEL_PIECE = 256  # characters of a label looked at together
SMOOTHING = 0.5
SEED_WEIGHT = 20.0
PRIOR = 0.05
PRIOR_HOSTS = 20
SUPPORT, PURITY, LIFT, PURE = 3, 0.25, 2.0, 0.75
TELLING_KINDS, TELLING_SHARE = 5, 0.05
ROUNDS = 3
BLOCK_SEEDS = ("bet", "poker", "porn", "tracker")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self):
        return self.host + self.path


def host_and_path(url):
    """(host, path) columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host, path, rules):
    """The longest fitting rule as struct(rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):  # the last one wraps the others, so it is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def zoned(host, rules):
    """The longest rule host that fits, whatever the path; null where none does."""
    out = F.lit(None).cast("string")
    for name in sorted({r.host for r in rules}, key=lambda h: (len(h), h)):
        out = F.when((host == name) | host.endswith("." + name), F.lit(name)).otherwise(out)
    return out


def named(rules):
    """(labels that rule hosts name, path segments that rule paths look at)."""
    labels = {x for r in rules for x in re.split(r"[\W\d_]+", r.host.lower()) if x}
    return sorted(labels), max((len([x for x in r.path.split("/") if x]) for r in rules), default=0)


def shown_words(pages: DataFrame, columns=(), html="html") -> DataFrame:
    """The columns, word, n: how often each word of the pages' visible text occurs."""
    visible = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = F.split(F.lower(visible), r"[^\p{L}]+")
    return pages.select(*columns, F.explode(words).alias("word")).filter("word <> ''").groupBy(*columns, "word").agg(F.count("*").alias("n"))


def unigrams(pages: DataFrame, html="html") -> DataFrame:
    return shown_words(pages, (), html)


def classed_hosts(pages: DataFrame, anchors: DataFrame, host="host", html="html") -> DataFrame | None:
    """host, bad (1 or 0) of the anchors and of every host that shows a word; bad are the anchors and the hosts whose pages
    show what bad hosts show. None where no word can tell.

    ``pages`` holds host and html. A word has one row for each host that shows it.
    """
    bad = n = None
    for step in range(ROUNDS):
        bad = anchors if bad is None else bad
        now = bad.count()
        if now < SUPPORT:
            return None
        if now == n:
            break
        if step == 0:
            shown = stored(shown_words(pages, (host,), html))
            totals = stored(shown.groupBy(host).agg(F.sum("n").alias("all_")))
            hosts = max(totals.count(), 1)
        n = now
        mine = shown.join(bad.withColumn("bad_", F.lit(1)), host, "left")
        told = mine.groupBy("word").agg(F.count("*").alias("hosts_"), F.sum(F.coalesce("bad_", F.lit(0))).alias("bad_"))
        share = F.col("bad_") / F.col("hosts_")
        told = told.filter((F.col("bad_") >= SUPPORT) & (share >= PURITY) & (share >= min(LIFT * n / hosts, PURE))).select("word")
        found = shown.join(told, "word").groupBy(host).agg(F.count("*").alias("kinds_"), F.sum("n").alias("n")).join(totals, host)
        found = found.filter((F.col("kinds_") >= TELLING_KINDS) & (F.col("n") >= TELLING_SHARE * F.col("all_"))).select(host)
        bad = stored(found.unionByName(anchors).distinct())
    every = totals.select(host, F.lit(0.0).alias("bad")).unionByName(bad.select(host, F.lit(1.0).alias("bad")))
    return stored(every.groupBy(host).agg(F.max("bad").alias("bad")))


def segmented(labels: DataFrame, counts: DataFrame, longest=LONGEST_WORD) -> DataFrame:
    """label, words: the likeliest split of each distinct label. A stretch that is no known word costs ten times more with
    each character."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    # Long labels go in pieces, each with the start of the next: counting characters from a far start costs as many steps.
    short = F.length("label") <= LABEL_PIECE
    named = labels.filter("label <> ''").withColumn("key", F.when(short, F.col("label")).otherwise(F.concat(F.lit("#"), F.md5("label"))))
    pieces = named.select("key", F.expr(
        f"posexplode(transform(sequence(0, (length(label) - 1) div {LABEL_PIECE}), k -> substr(label, k * {LABEL_PIECE} + 1, {LABEL_PIECE + int(longest) - 1})))"
    ).alias("k", "piece"))
    parts = F.expr(
        f"flatten(transform(sequence(1, least({LABEL_PIECE}, length(piece))), i -> transform(sequence(1, least({int(longest)}, length(piece) - i + 1)),"
        f" n -> named_struct('start', k * {LABEL_PIECE} + i - 1, 'word', substr(piece, i, n)))))"
    )
    # The planner takes the substrings for as few as the labels; merged, they are never broadcast.
    known = pieces.select("key", F.inline(parts)).hint("merge").join(counts, "word").groupBy("key").agg(
        F.collect_list(F.struct("start", F.length("word").alias("size"), "n")).alias("edges")  # at most label x longest
    )
    split = F.pandas_udf(_splitter(total, longest), "array<string>")
    return named.join(known, "key", "left").select("label", split("label", "edges").alias("words"))


def _splitter(total, longest):
    def split(labels: pd.Series, edges: pd.Series) -> pd.Series:
        return pd.Series([viterbi(label, [] if e is None else e, total, longest) for label, e in zip(labels, edges)])

    return split


def viterbi(label, edges, total, longest=LONGEST_WORD):
    """Words of the label with the highest product of unigram probabilities; ties go to the shorter last word."""
    gain = {(e["start"], e["start"] + e["size"]): math.log(e["n"] / total) for e in edges}
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        ways = []
        for start in range(end - 1, max(-1, end - 1 - longest), -1):
            score = gain.get((start, end), -math.log(total) - (end - start - 1) * math.log(10) - math.log(10))
            ways.append((best[start][0] + score, start))
        best.append(max(ways))
    words, end = [], len(label)
    while end:
        words.append(label[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def learnt_from(tokens: DataFrame, smoothing=SMOOTHING, seeds=(), seed_weight=SEED_WEIGHT, besides: DataFrame = None) -> DataFrame:
    """token, odds: log odds of ``block`` of each token, from rows (host, zone, pages, block, tokens) that rules decide, and
    from token counts (token, b, a) known besides."""
    totals = tokens.groupBy("host").agg(F.sum("pages").alias("all_"))
    share = F.col("n") / F.col("all_")  # of the host's pages; all its pages weigh one
    zones = tokens.groupBy("zone", "host", "block").agg(F.sum("pages").alias("n")).join(totals, "host").withColumn("n", share)
    zones = zones.groupBy("zone").agg(*_counted()).filter("b > 0 AND a > 0")
    zones = zones.select("zone", (F.least("b", "a") / F.col("b")).alias("for_b"), (F.least("b", "a") / F.col("a")).alias("for_a"))
    told = tokens.select("zone", "host", "block", "pages", F.explode("tokens").alias("token"))
    told = told.groupBy("zone", "host", "block", "token").agg(F.sum("pages").alias("n")).join(totals, "host").withColumn("n", share)
    told = told.groupBy("zone", "token").agg(*_counted()).join(zones, "zone")
    told = told.groupBy("token").agg(F.sum(F.col("b") * F.col("for_b")).alias("b"), F.sum(F.col("a") * F.col("for_a")).alias("a"))
    told = stored(told if besides is None else told.unionByName(besides).groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a")))
    b, a, kinds = told.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    if seeds:  # they add to their own tokens, not to the totals
        seeded = tokens.sparkSession.createDataFrame([(f"host:{w}{s}", float(seed_weight), 0.0) for w in seeds for s in ("", "s")], "token string, b double, a double")
        told = told.unionByName(seeded).groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    b, a = (b or 0.0) + smoothing * (kinds + 1), (a or 0.0) + smoothing * (kinds + 1)
    return told.select("token", (F.log((F.col("b") + smoothing) / b) - F.log((F.col("a") + smoothing) / a)).alias("odds"))


def judged(
    pages: DataFrame, rules, page_id="page_id", url="url", html="html", seeds=BLOCK_SEEDS, smoothing=SMOOTHING, seed_weight=SEED_WEIGHT, prior=PRIOR
):
    """page id, host, path, rule, verdict, score (log odds of ``block`` by the method) of every page."""
    host, path = host_and_path(F.col("url_"))
    urls = pages.select(F.col(page_id), F.col(url).cast("string").alias("url_")).select(page_id, host.alias("host"), path.alias("path"))
    urls = urls.withColumn("ruled", ruled(F.col("host"), F.col("path"), rules))
    seen = stored(urls.groupBy("host", "path").agg(F.count("*").alias("pages"), F.first("ruled").alias("ruled")))

    own, depth = named(rules)
    hosts = seen.select("host").distinct()
    labels = hosts.select("host", F.posexplode(F.split("host", r"[^\p{L}]+")).alias("place", "label")).filter("label <> ''")
    labels = labels.filter(~F.col("label").isin(own))
    words = segmented(labels.select("label").distinct(), stored(unigrams(pages, html)))
    by_host = labels.join(words, "label").groupBy("host").agg(  # bounded by the host's length
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: x["words"])).alias("words")
    )
    beyond = F.regexp_replace(F.translate("path", _UPPER, _LOWER), f"^(?:/*[^/]+){{0,{depth}}}", "")
    of_path = F.filter(F.split(beyond, r"[^\p{L}\p{N}]+"), lambda t: t != "")
    of_path = F.transform(of_path, lambda t: F.concat(F.lit("path:"), F.when(t.rlike(r"^\p{N}+$"), "#").otherwise(t)))
    of_host = F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda t: F.concat(F.lit("host:"), t))
    tokens = stored(seen.join(by_host, "host", "left").select("host", "path", "pages", "ruled", F.concat(of_host, of_path).alias("tokens")))

    block = F.col("ruled.verdict") == "block"
    decided = tokens.filter("ruled IS NOT NULL").select("host", zoned(F.col("host"), rules).alias("zone"), "pages", block.alias("block"), "tokens")
    by_host = tokens.groupBy("host").agg(F.sum("pages").alias("all_"))
    seeded = F.array(*[F.lit(f"host:{w}{s}") for w in seeds for s in ("", "s")]).cast("array<string>")
    anchors = stored(tokens.filter(F.arrays_overlap("tokens", seeded)).select("host").distinct())
    shown = pages.select(host_and_path(F.col(url).cast("string"))[0].alias("host"), html)
    classes, besides = classed_hosts(shown, anchors, html=html), None
    if classes is not None:
        n, bad = classes.agg(F.count("*"), F.sum("bad")).first()
        prior = (bad + prior * PRIOR_HOSTS) / (n + PRIOR_HOSTS)
        besides = tokens.select("host", "pages", F.explode("tokens").alias("token")).groupBy("host", "token").agg(F.sum("pages").alias("n"))
        share = F.col("n") / F.col("all_")  # a host weighs one, however many pages it has
        besides = besides.join(by_host, "host").join(classes, "host").groupBy("token").agg(
            F.sum(share * F.col("bad")).alias("b"), F.sum(share * (1 - F.col("bad"))).alias("a")
        )
    learnt = learnt_from(decided, smoothing, seeds, seed_weight, besides)
    told = tokens.filter("ruled IS NULL").select("host", "path", F.explode("tokens").alias("token"))
    told = told.join(learnt, "token").groupBy("host", "path").agg(F.round(F.sum("odds"), 9).alias("sum_"))  # a token no class has says nothing

    score = F.when(F.col("ruled").isNull(), F.coalesce("sum_", F.lit(0.0)) + math.log(prior / (1 - prior)))
    verdict = F.coalesce("ruled.verdict", F.when(score > 0, "block").otherwise("allow"))
    return urls.join(told, ["host", "path"], "left").select(
        page_id, "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"), score.alias("score")
    )


def _counted():
    return F.sum(F.when(F.col("block"), F.col("n")).otherwise(0.0)).alias("b"), F.sum(F.when(F.col("block"), 0.0).otherwise(F.col("n"))).alias("a")
