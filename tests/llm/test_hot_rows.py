"""Hot groups, null and repeated ids, against plain versions."""

import math
import random

import pytest

from cotejo.llm import near_duplicates, quality
from tests.llm import brute


def families(seed=5):
    """A large family around one text, borderline members included, and some others."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(260):
        words = list(base)
        for k in draw.sample(range(60), draw.choice((0, 1, 2, 4, 6))):
            words[k] = f"x{draw.randrange(40)}"
        rows.append((i, " ".join(words)))
    return rows + [(1000 + i, " ".join(f"v{i}_{k}" for k in range(30))) for i in range(60)]


@pytest.mark.parametrize("heavy, block", [(2, 16), (1000, 1024), (50, 7)])
def test_hot_centre(spark, monkeypatch, heavy, block):
    """The links do not depend on how a hot centre's sets are dealt."""
    monkeypatch.setattr(near_duplicates, "HEAVY", heavy)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", block * 40)
    rows = families()
    got = near_duplicates.classified(spark.createDataFrame(rows, "doc_id long, text string"), size=2, keep=["doc_id"]).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute.near_duplicates(rows)


def test_null_and_repeated_ids_of_near_duplicates(spark):
    """5,000 rows without an id and 2,000 that share one meet only the rows of their own text."""
    texts = [t for _, t in families()]
    rows = [(None, f"{t} tail{i % 3}") for i, t in enumerate(texts * 16)][:5000]
    rows += [(7, f"{t} end{i}") for i, t in enumerate(texts * 7)][:2000]
    rows += [(7, None), (None, None), (None, "")]
    got = near_duplicates.classified(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert len(got) == len(rows)
    numbered = list(enumerate(dict.fromkeys(t for _, t in rows if t)))
    part = {numbered[i][1]: c for i, (_, c, _) in brute.near_duplicates(numbered).items()}
    least = {}
    for i, t in rows:
        if t and i is not None:
            least[part[t]] = min(i, least.get(part[t], i))
    assert all(r["component_id"] == (least.get(part[r["text"]]) if r["text"] else r["doc_id"]) for r in got)


def plain_covering(cells, sizes, precision):
    """The decision list by asking every cell anew for every literal."""

    def tally(rule, grow):
        inside = [c for c in cells if c[1] == grow and all((c[0][k] > at) == above for k, above, at in rule)]
        return sum(c[2] for c in inside), sum(c[3] for c in inside)

    rules = []
    while len(rules) < quality.MOST_RULES:
        rule = []
        while len(rule) < quality.MOST_LITERALS:
            bad, good = tally(rule, True)
            if not bad or not good:
                break
            gains = []
            for one in [(k, above, at) for k, n in enumerate(sizes) for at in range(n) for above in (True, False)]:
                b, g = tally([*rule, one], True)
                gains.append((b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good))) if b else 0.0, one))
            gain, one = max(gains, key=lambda x: x[0])
            if gain <= 1e-9:
                break
            rule.append(one)
        on_rest = [tally(rule[:n], False) for n in range(1, len(rule) + 1)]
        if not on_rest:
            break
        n = max(range(len(rule)), key=lambda n: ((on_rest[n][0] - on_rest[n][1]) / max(sum(on_rest[n]), 1), -n))
        b, g = on_rest[n]
        if b < 3 or b < precision * (b + g):
            break
        rules.append(tuple(rule[:n + 1]))
        cells = [c for c in cells if not all((c[0][k] > at) == above for k, above, at in rules[-1])]
    return rules


@pytest.mark.parametrize("seed", range(12))
def test_covering_against_a_plain_version(seed):
    draw = random.Random(seed)
    sizes = [3, 5, 1, 4][: 1 + seed % 4]
    cells = []
    for _ in range(300):
        at = tuple(draw.randrange(n + 1) for n in sizes)
        bad = draw.randrange(30) if at[0] > 1 or at[-1] == 0 else draw.randrange(2)
        cells.append((at, draw.random() < 0.66, bad, draw.randrange(1 + 3 * (at[0] <= 1))))
    got = quality._covering(cells, sizes, 0.8)
    assert got == plain_covering(cells, sizes, 0.8) and (got or seed % 4 == 0)
    assert quality._covering([], sizes, 0.8) == []
