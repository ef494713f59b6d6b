"""The URL filter's two views: hosts held out of both seeds and rules, and plain versions of its parts."""

import math
import random

from cotejo.llm import queries, url_filter

TOPIC = ["jackpot", "roulette", "spins", "slots", "payout", "wager", "bonus", "dealer"]
PLAIN = ["river", "garden", "kitchen", "music", "school", "winter", "travel", "museum", "paper", "bridge", "forest", "market", "letter", "window", "city"]
BAD = ["spin", "royal", "lucky", "slot"]
GOOD = ["green", "old", "north", "red", "lake", "book", "stone", "hill"]


def site(draw, bad):
    """Visible words of a page; bad ones mix the topic's words into plain ones."""
    words = [draw.choice(PLAIN) for _ in range(60)]
    return " ".join(words + [draw.choice(TOPIC) for _ in range(15)] if bad else words)


def fixture(seed=11):
    """(url, html, bad, kind): hosts with a seed word, hosts that only their pages betray, and held-out ones without pages."""
    draw, rows = random.Random(seed), []
    every = f"<p>{' '.join(BAD + GOOD + ['poker', 'the'] + PLAIN)}</p>"
    for a in BAD:
        for b in PLAIN[:3]:
            rows += [(f"http://poker{b}{a}.net/x/{n}", f"<p>{site(draw, True)}</p>", True, "seed") for n in range(2)]
        for b in PLAIN[3:9]:
            rows += [(f"http://{a}{b}.net/x/{n}", f"<p>{site(draw, True)}</p>", True, "pages") for n in range(3)]
        for b in PLAIN[9:13]:
            rows.append((f"http://{b}{a}.net/x/1", None, True, "url"))
    for a in GOOD:
        for b in PLAIN[:8]:
            rows += [(f"http://{a}{b}.net/x/{n}", f"<p>{site(draw, False)}</p>", False, "pages") for n in range(3)]
        for b in PLAIN[8:14]:
            rows.append((f"http://{b}{a}.net/x/1", None, False, "url"))
    return rows + [("http://thegarden.net/x/1", every, False, "pages")]


def judge(spark, rows, **more):
    pages = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "page_id long, url string, html string")
    return {r["page_id"]: r for r in url_filter.judged(pages, queries.URL_RULES, **more).collect()}


def test_hosts_that_no_seed_names(spark):
    rows = fixture()
    got = judge(spark, rows)
    assert all(r["rule"] is None for r in got.values())
    for kind in ("pages", "url"):  # no host of these holds a seed word, those of kind url show nothing at all
        said = [(got[i]["verdict"] == "block", r[2]) for i, r in enumerate(rows) if r[3] == kind]
        right = sum(a and b for a, b in said)
        assert right >= 0.9 * sum(a for a, _ in said) and right >= 0.9 * sum(b for _, b in said) and right
    calm = judge(spark, [r for r in rows if not r[2]])  # without bad hosts nothing is blocked
    assert {r["verdict"] for r in calm.values()} == {"allow"}


def test_scores_against_plain_naive_bayes(spark):
    """Score of every page by plain counting over the hosts' classes."""
    rows = fixture(3)
    got = judge(spark, rows)
    counts = {}
    for r in rows:
        for w in (r[1] or "")[3:-4].split():
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())

    def tokens(url):
        host, path = url[7:].split("/", 1)
        label = host.split(".")[0]
        edges = [{"start": i, "size": n, "n": counts[label[i:i + n]]} for i in range(len(label)) for n in range(1, len(label) - i + 1) if label[i:i + n] in counts]
        return host, {f"host:{w}": label_words.count(w) for label_words in [url_filter.viterbi(label, edges, total)] for w in label_words}, path

    hosts = {}
    for r in rows:
        host, words, path = tokens(r[0])
        parts = [p for p in path.split("/") if p][1:]  # the first segment is as deep as the rules look
        hosts.setdefault(host, (words, []))[1].append("path:#" if parts else None)
    bad = {tokens(r[0])[0] for r in rows if r[2] and r[3] != "url"}
    mute = {tokens(r[0])[0] for r in rows if r[1] is None}
    b, a = {}, {}
    for host, (words, paths) in hosts.items():
        if host in mute:
            continue
        side = b if host in bad else a
        for w, n in words.items():
            side[w] = side.get(w, 0) + n
        side["path:#"] = side.get("path:#", 0) + sum(p is not None for p in paths) / len(paths)
    kinds = set(a) | set(b)
    sum_b, sum_a = (sum(x.values()) + 0.5 * (len(kinds) + 1) for x in (b, a))
    for w in {f"host:{s}{e}" for s in url_filter.BLOCK_SEEDS for e in ("", "s")}:
        b[w] = b.get(w, 0) + url_filter.SEED_WEIGHT
    odds = {w: math.log((b.get(w, 0) + 0.5) / sum_b) - math.log((a.get(w, 0) + 0.5) / sum_a) for w in set(a) | set(b)}
    prior = (len(bad) + 0.05 * 20) / (len(hosts) - len(mute) + 20)
    for i, r in enumerate(rows):
        words = tokens(r[0])[1]
        want = sum(n * odds.get(w, 0.0) for w, n in words.items()) + odds["path:#"] + math.log(prior / (1 - prior))
        assert abs(got[i]["score"] - want) < 1e-6, (r, got[i]["score"], want)
