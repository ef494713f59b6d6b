"""The operators against plain versions, on whole small tables and on rows made to be awkward."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cotejo.llm import decontaminate, language_id, mixing, near_duplicates, quality, queries, repeated_bytes, secrets, token_counts, toxicity, url_filter
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def by_id(rows):
    return {r[0]: tuple(r)[1:] for r in rows}


PASSAGE = " ".join(f"passage{i}" for i in range(60))
AWKWARD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n\t ", "de", None, 3), (None, "no id here " * 12, "en", "b", 9),
    (None, "no id here " * 12, "en", "b", 9), (4, "same row " * 40, None, "a", 1), (4, "same row " * 40, None, "a", 1), (4, "same id, other text " * 12, "fr", "a", 1),
    (5, "x", "en", "a", 1), (6, "\x00\x00 zero bytes \x00" * 30, "en", "a", 1), (7, "ÀÉ ünïcode ▁ mark▁ " * 30, "fr", "b", 1),
    (8, PASSAGE + " tail one", "en", "b", 1), (9, "head two " + PASSAGE, "en", "b", 1), (10, "w" * 30000 + " " + "long words " * 4000, "en", "c", 1),
    (11, "word", "en", "c", 1), (12, "a b", "en", "c", 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(AWKWARD, schema)
    clashing = ("n_words", "N_HIT", "spans", "items", "score", "kept", "n_tokens", "row_", "component_id", "copies", "removed", "rule", "n_bytes")
    return frame.selectExpr("*", *[f"'extra' AS {c}" for c in clashing])


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# ---- 1 decontamination


def items(spark):
    rows = [(1, PASSAGE), (2, "a b"), (3, None), (4, " . "), (None, "zero bytes"), (10, "id here no"), (10, "other text same")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination(spark, docs):
    bench = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert by_id(queries.op1_decontamination(spark, SF).collect()) == brute.contamination(docs, bench)


@pytest.mark.parametrize("block_words", [1 << 20, 12])
def test_decontamination_blocks(spark, awkward, block_words):
    """Any number of benchmark blocks gives the same rows."""
    got = decontaminate.contamination(awkward, items(spark), block_words=block_words, keep=["doc_id", "text"]).collect()
    bench = [(i, t) for i, t in [(1, PASSAGE), (2, "a b"), ("", "zero bytes"), (10, "id here no"), (10, "other text same")]]
    for r in got:
        want = brute.contamination([(0, r["text"])], bench)[0]
        assert (r["n_words"], r["n_hit"], r["contaminated"]) == (want[0], want[1], want[4])
        names = {i for i, t in bench if i != "" and brute.contamination([(0, r["text"])], [(i, t)])[0][4]}
        assert r["items"] == sorted(map(str, names))
    assert len(got) == len(AWKWARD)
    assert decontaminate.clean(awkward, items(spark)).columns == awkward.columns
    assert decontaminate.contamination(empty(spark), items(spark)).count() == 0
    assert decontaminate.contamination(awkward, items(spark).limit(0)).filter("contaminated").count() == 0


def test_longest_matches(spark):
    frame = spark.createDataFrame([(1, "x " + PASSAGE), (2, " ".join(PASSAGE.split()[5:30]))], "doc_id long, text string")
    found = {r["item_word"]: (r["length"], r["doc_id"], r["doc_word"]) for r in decontaminate.longest_matches(frame, items(spark)).collect()}
    assert found[0] == (60, 1, 1) and found[50] == (10, 1, 51)


def test_suffix_array():
    rng = np.random.default_rng(3)
    words = rng.integers(1, 4, 300).astype(np.uint64)
    ends = np.repeat([100, 101, 300], [100, 1, 199])
    order = decontaminate.suffix_array(words, ends, 400)
    assert sorted(range(300), key=lambda i: (list(words[i:ends[i]]), )) == sorted(order, key=lambda i: (list(words[i:ends[i]]),))
    shown = [list(words[i:ends[i]]) for i in order]
    assert shown == sorted(shown)


# ---- 2 URL filter


def test_url_rules(spark):
    urls = [
        "http://a.EXAMPLE.com/en/x", "http://www.example.com/en/x?q#f", "https://x.com/a", "ftp://b.net/es/1", "b.net/es/1", None, "http://net/fr/", "http://notnet/fr/",
        "http://free-bets.shop.org/de/1", "", "://", "http://h?x/y",
    ]
    pages = spark.createDataFrame([(i, u, "<p>free bets the word</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judged(pages, queries.URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best and best.name)
        assert best is None or got[i]["verdict"] == best.verdict
    assert got[8]["verdict"] == "block"
    assert url_filter.judged(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_clean_hosts(spark):
    """What the rules look at is no evidence on pages no rule decides: neither a zone of one verdict, nor path prefixes."""
    clean = ["garden", "river", "stone", "cloud", "forest", "meadow"]
    urls = [f"http://{w}.example.{top}/{lang}/{n}" for w in clean for top in ("com", "net", "org") for lang in ("en", "es", "de") for n in range(5)]
    urls += [f"http://poker.{w}.example.org/en/1" for w in clean]
    pages = spark.createDataFrame([(i, u, f"<p>{' '.join(clean)} poker example</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judged(pages, queries.URL_RULES).collect()}
    for i, u in enumerate(urls):
        if got[i]["rule"] is None:
            assert got[i]["verdict"] == ("block" if "poker" in u else "allow"), u


def test_url_learns_in_a_zone(spark):
    """A word under many blocked hosts of a zone and no allowed one is met again outside; a large host counts once."""
    rules = [url_filter.Rule("site.com", "/", "allow"), url_filter.Rule("site.com", "/x/", "block")]
    urls = [f"http://w{'abcdefghijklmnopqrstuvwxyz'[n]}.zilch.site.com/x/1" for n in range(26)]
    urls += [f"http://k{'abcdefghijklmnopqrstuvwxyz'[n]}.plain.site.com/y/1" for n in range(26)]
    urls += [f"http://bulk.site.com/x/{n}" for n in range(200)] + ["http://zilch.org/", "http://plain.org/", "http://bulk.org/"]
    pages = spark.createDataFrame([(i, u, "<p>zilch plain bulk</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in url_filter.judged(pages, rules).collect()}
    assert (got["zilch.org"], got["plain.org"], got["bulk.org"]) == ("block", "allow", "allow")


def test_url_seeds_and_long_words(spark):
    """Common words block nothing by default, a caller's seeds do; a word as long as its label is found whole."""
    word = "pneumonoultramicroscopicsilicovolcanoconiosis"
    urls = ["http://www.farm.org/", "http://win.org/x", "http://track.org/", "http://pokers.org/", f"http://{word}.org/"]
    pages = spark.createDataFrame([(i, u, f"<p>farm win track poker pokers {word} org</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages, queries.URL_RULES).collect()}
    assert [got[i] for i in range(5)] == ["allow", "allow", "allow", "block", "allow"]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages, queries.URL_RULES, seeds=("farm", word)).collect()}
    assert [got[i] for i in range(5)] == ["block", "allow", "allow", "allow", "block"]


def test_viterbi():
    counts = {"free": 50, "bets": 20, "fre": 1, "ebets": 1, "be": 30}
    edges = [{"start": i, "size": j - i, "n": counts[w]} for i in range(8) for j in range(i + 1, 9) if (w := "freebets"[i:j]) in counts]
    assert url_filter.viterbi("freebets", edges, sum(counts.values())) == ["free", "bets"]


# ---- 3 repeated bytes


def test_repeated_bytes(spark, docs):
    assert by_id(queries.op3_repeated_bytes(spark, SF).collect()) == brute.repeated(docs)


def hard_texts():
    rng = random.Random(5)
    base = ["".join(rng.choice("ab \n\x00é") for _ in range(400)) for _ in range(3)]
    out = [(i, base[i % 3][rng.randrange(200):] + base[rng.randrange(3)][:rng.randrange(400)]) for i in range(60)]
    out += [(60, "z" * 700), (61, "z" * 99), (62, "yz" * 300 + "z" * 150), (63, "q" * 100), (64, "q" * 100), (65, base[0] + base[0])]
    return out


@pytest.mark.parametrize("hot", [40, 2])
def test_repeated_bytes_hard(spark, monkeypatch, hot):
    """Periodic texts, zero bytes, repeats inside one document; with and without hot anchors."""
    monkeypatch.setattr(repeated_bytes, "HOT_DOCUMENTS", hot)
    texts = hard_texts()
    out = repeated_bytes.repeated(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["removed"]), hashlib.sha256(r["kept_text"]).hexdigest()) for r in out}
    assert got == brute.repeated(texts)


def test_repeated_bytes_awkward(spark, awkward):
    out = repeated_bytes.repeated(awkward).collect()
    assert len(out) == len(AWKWARD)
    twice = sorted(r["n_removed"] for r in out if r["doc_id"] == 4 and r["text"].startswith("same row"))
    assert twice[1] == len("same row " * 40) and twice[0] < twice[1]
    assert sum(r["n_removed"] for r in out if r["doc_id"] is None) > 0
    assert repeated_bytes.repeated(empty(spark)).count() == 0


def test_transform_rows():
    """Rows, symbols and common prefixes of the column-wise transform, against sorted suffixes."""
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    width = max(map(len, texts))
    columns = np.zeros((len(texts), width), np.uint8)
    for i, t in enumerate(texts):
        columns[i, width - len(t):] = list(t)
    rows = repeated_bytes.transform(columns, np.array([len(t) for t in texts]), 16)
    want = sorted(([*[b + 1 for b in t[len(t) - n:]], 0, i], i, n) for i, t in enumerate(texts) for n in range(len(t) + 1))
    assert [(s >> 16, s & 65535) for s in rows.suffix.tolist()] == [(i, n) for _, i, n in want]
    for k, (_, i, n) in enumerate(want):
        t = texts[i]
        assert rows.before[k] == (0 if n == len(t) else t[len(t) - n - 1] + 1)
        if k:
            j, m = want[k - 1][1:]
            a, b, c = t[len(t) - n:], texts[j][len(texts[j]) - m:], 0
            while c < min(len(a), len(b), 16) and a[c] == b[c]:
                c += 1
            assert rows.common[k] == c


# ---- 4 token counts


def test_token_counts(spark, docs, awkward):
    library = token_counts.load(queries.tokenizer_path())
    got = by_id(queries.op4_token_counts(spark, SF).collect())
    assert {d: g[1] for d, g in got.items()} == {d: len(library.encode(t or "")) for d, t in docs}
    for r in token_counts.token_counts(awkward, queries.tokenizer_path()).collect():
        t = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n := len(library.encode(t)), n > 4096)


def test_token_counts_spaces():
    counts = token_counts._Counts(token_counts.load(queries.tokenizer_path()), token_counts.whole_tokens(queries.tokenizer_path()))
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice([" ", "  ", "▁", "a", "the", "\n", "<s>", "é", "\x00", "🙂", "ing"]) for _ in range(rng.randrange(9)))
        assert counts.of(text) == len(counts.library.encode(text)), repr(text)


# ---- 5 toxicity


def slow_forward(m):
    out, v = [], np.array([0.5, 0.5])
    for a, b, c, d in m.T:
        v = v @ np.array([[a, b], [c, d]])
        v = v / v.sum()
        out.append(v)
    return np.array(out).T


def test_forward():
    m = np.random.default_rng(0).random((4, 9000)) + 1e-3
    assert np.allclose(toxicity.forward(m), slow_forward(m))


def test_toxicity(spark, awkward):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        t = [rng.choice(words) for _ in range(60)]
        labels.append(i % 3 == 0)
        if labels[-1]:
            t[rng.randrange(60)] = rng.choice(["vile", "nasty"])
        texts.append(" ".join(t))
    field = toxicity.train(texts[:300], np.array(labels[:300]))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = toxicity.toxicity(frame, field).collect()
    late = [(r["predicted"] == 1) == labels[r["doc_id"]] for r in out if r["doc_id"] >= 300]
    assert sum(late) >= 0.95 * len(late)
    for r in out:
        assert all(r["text"][s["start"]:s["stop"]] in ("vile", "nasty") for s in r["spans"])
    assert toxicity.toxicity(awkward, field).filter("score BETWEEN 0 AND 1").count() == len(AWKWARD)
    none = toxicity.train([], np.array([], bool))
    assert {r["score"] for r in toxicity.toxicity(awkward, none, keep=["doc_id"]).collect()} == {0.5}
    assert toxicity.toxicity(empty(spark), field).count() == 0


def test_toxicity_rare_words(spark):
    """Words of one toxic document in 30 are learnt when enough labelled rows hold them, also where the sample has none."""
    rng = random.Random(3)
    plain = [f"plain{chr(97 + k)}{chr(97 + j)}" for k in range(26) for j in range(4)]
    text = lambda *more: " ".join(sorted([*rng.choices(plain, k=30), *more], key=lambda _: rng.random()))
    rows = [(i, text(*(["qqvile"] * 3 if i % 60 else ["zzrude"] * 3)) if i % 2 == 0 else text(), (i + 1) % 2) for i in range(3600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    known = toxicity.vocabulary(docs, labels)
    assert [len(k) for k in known] == [2, 2]
    texts, kinds = toxicity.labelled(docs, labels, sample=60)
    for rare in (texts, [t.replace("zzrude", "plainaa") for t in texts]):
        field = toxicity.train(rare, kinds, known=known)
        new = spark.createDataFrame([(1, text("zzrude", "zzrude", "zzrude")), (2, text())], "doc_id long, text string")
        assert {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(new, field).collect()} == {1: 1, 2: 0}
    old = toxicity.train(texts, kinds)
    assert toxicity.toxicity(new.filter("doc_id = 1"), old).first()["predicted"] == 0
    nothing = toxicity.vocabulary(docs.limit(0), labels)
    assert [len(k) for k in nothing] == [0, 0]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in queries.op5_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in out) >= 0.9 * len(out)


# ---- 6 languages


def test_language_id(spark, awkward):
    sf = "/root/testdata/sf0.01"
    want = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in queries.op6_language_id(spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in out) >= 0.95 * len(out)
    model = language_id.train(*language_id.labelled(spark.read.parquet(f"{sf}/documents.parquet"), sample=30))
    got = language_id.identified(awkward, model).collect()
    assert {r["lang_pred"] for r in got if not any(map(str.isalpha, r["text"] or ""))} == {"und"}
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or ""))) and 0 <= r["score"] <= 1 for r in got)
    assert language_id.identified(awkward, language_id.train([], [])).filter("lang_pred <> 'und'").count() == 0


def test_presence():
    texts = ["abcab", "", "ABé"]
    x = language_id.presence(pa.array(texts, pa.large_string()))
    grams = [{t.lower().encode()[i:i + n] for n in language_id.ORDERS for i in range(len(t.encode()) - n + 1)} for t in texts]
    assert x.sum(1).tolist() == [len(g) for g in grams]  # no two of these share a slot


# ---- 7 near-duplicates


def test_near_duplicates(spark, docs):
    assert by_id(queries.op7_near_duplicates(spark, SF).collect()) == brute.near_duplicates(docs)


def test_near_duplicates_chain(spark):
    """A chain of texts, each near the next only, small sets at the threshold, and a group of near copies."""
    rng = random.Random(8)
    words = [f"t{i}" for i in range(400)]
    rows, text = [], words[:100]
    for i in range(12):
        rows.append((i, " ".join(text)))
        text = text[8:] + [f"n{i}_{k}" for k in range(8)]
    base = words[200:300]
    for i in range(20, 60):
        t = list(base)
        for _ in range(rng.randrange(7)):
            t[rng.randrange(100)] = f"edit{rng.random()}"
        rows.append((i, " ".join(t)))
    rows += [(70, "a b c d e"), (71, "a b c d e f"), (72, "p q"), (73, "P Q"), (74, "p"), (75, "p"), (76, "a b c d")]
    got = near_duplicates.classified(spark.createDataFrame(rows, "doc_id long, text string"), size=2, keep=["doc_id"]).collect()
    assert by_id(got) == brute.near_duplicates(rows)


def test_near_duplicates_awkward(spark, awkward):
    out = near_duplicates.classified(awkward, size=2).collect()
    assert len(out) == len(AWKWARD)
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in out if r["n_shingles"] == 0)
    first = near_duplicates.first_of_each(awkward)
    assert first.columns == awkward.columns
    texts = Counter(r["text"] for r in first.collect())
    assert texts["same row " * 40] == 1 and texts["no id here " * 12] == 1 and texts[None] == 1 and texts[""] == 1
    assert near_duplicates.classified(empty(spark)).count() == 0 and near_duplicates.first_of_each(empty(spark)).count() == 0


def test_register_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (0.5, 0.8, 0.95):
        n = int(1000 * 2 * share / (1 + share))
        a, b = pool[:1000], np.concatenate([pool[:n], pool[2000:3000 - n]])
        owner = np.repeat([0, 1], 1000)
        regs = near_duplicates.registers(owner, np.concatenate([a, b]), 2)
        assert abs(near_duplicates.estimate(regs[:1], regs[1:])[0] - n / (2000 - n)) < 0.12


# ---- 8 secrets


def test_secrets(spark, docs, awkward):
    assert {d: g[:4] for d, g in by_id(queries.op8_secrets(spark, SF).collect()).items()} == {d: brute.base_secrets(t) for d, t in docs}
    assert secrets.secrets(awkward).count() == len(AWKWARD)


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else (b"\x82" + len(body).to_bytes(2, "big"))
    return bytes([tag]) + size + body


def test_confirmed_secrets(spark):
    import base64
    import json

    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    sec1 = der(0x30, der(2, b"\x01"), der(4, b"k" * 32))
    pkcs8 = der(0x30, der(2, b"\x00"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, b"x" * 120))
    pkcs1 = der(0x30, der(2, b"\x00"), *[der(2, b"\x11" * 40) for _ in range(8)])
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1rest"
    for key in (sec1, pkcs8, pkcs1, ssh):
        for text in (base64.b64encode(key).decode(), key.hex()):
            assert [s[0] for s in secrets.confirmed_spans(f"x {text} y")] == [4]
            broken = base64.b64encode(key[:-3]).decode() if text != key.hex() else key[:-3].hex()
            assert key is ssh or not secrets.confirmed_spans(f"x {broken} y")
    body = base64.encodebytes(pkcs1).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body}-----END RSA PRIVATE KEY-----"
    assert 5 in [s[0] for s in secrets.confirmed_spans(pem)]
    text = f"é token {jwt} end"
    assert secrets.confirmed_spans(text) == [(3, 8, 8 + len(jwt))]
    assert not secrets.confirmed_spans(text.replace("eyJ", "eyX"))
    assert secrets.redact(f"a password=abcdefghijklmnop b {jwt} c") == "a <secret> b <secret> c"
    frame = spark.createDataFrame([(1, None), (2, "x password=abcdefghijklmnop")], "doc_id long, text string")
    assert {r[0]: r[1] for r in secrets.redacted(frame).collect()} == {1: None, 2: "x <secret>"}


# ---- 9 quality


def test_quality(spark, docs, awkward):
    got = by_id(queries.op9_quality_rules(spark, SF).collect())
    assert {d: g[:6] for d, g in got.items()} == {d: brute.quality(t) for d, t in docs}
    for r in quality.statistics(awkward.drop("n_words")).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.quality(r["text"])[:5]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.kept_documents(awkward, labels).columns == awkward.columns
    assert quality.kept_documents(empty(spark), labels).count() == 0


def test_quality_rules(spark):
    """The list finds planted conjunctions and keeps good documents."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "mu", "nu"]) + str(rng.randrange(99)) for _ in range(80)]
        bad = i % 3 == 0
        if bad:
            words = [w + "##" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = quality.kept_documents(frame, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert {r["doc_id"] for r in kept} == {i for i in range(900) if i % 3}


def test_quality_is_native(spark):
    plan = queries.op9_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- 10 mixing


def test_mixing(spark):
    rows = queries.op10_mixing(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op10_mixing(spark, SF).collect()))
    source = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    sizes, taken, goal, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        goal[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = brute.targets(sizes)
    for s in sizes:
        assert goal[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= largest[s]


def test_mixing_tree(spark, awkward):
    """Many small blocks, a hot source, a null source, empty texts: targets are met through the tree."""
    data = [(i, "w " * (i % 7), None if i % 5 == 0 else "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    rows = mixing.stored(mixing.sized(spark.createDataFrame(data, "doc_id long, text string, source string"), ["doc_id"]))
    out = mixing.mixed(rows, mixing.targets(rows), block_rows=50, fan=3).collect()
    assert len(out) == 3000
    sizes, taken, goal = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        goal[r["source"]] = r["target"]
    want = brute.targets(sizes)
    assert all(goal[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 6 for s in sizes)
    rows = mixing.sized(awkward, ["doc_id", "text"])
    assert mixing.mixed(rows, mixing.targets(rows)).count() == len(AWKWARD)
    rows = mixing.sized(empty(spark), ["doc_id"])
    assert mixing.mixed(rows, mixing.targets(rows)).count() == 0


def test_meet_keeps_the_mean():
    rng = random.Random(3)
    totals = [0.0, 0.0]
    for _ in range(20000):
        part, size = [0.3, 0.6], [2, 5]
        mixing.meet(part, size, 0, 1, rng.random())
        assert part[0] * 2 + part[1] * 5 == pytest.approx(3.6) and min(part + [1 - p for p in part]) >= -1e-12
        assert min(abs(p - round(p)) for p in part) < 1e-12
        totals = [t + p for t, p in zip(totals, part)]
    assert totals[0] / 20000 == pytest.approx(0.3, abs=0.01) and totals[1] / 20000 == pytest.approx(0.6, abs=0.01)
