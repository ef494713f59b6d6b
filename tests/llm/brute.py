"""Plain versions of the contracts, one document or one pair at a time."""

import hashlib
import re
from collections import Counter

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_AZ))


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contamination(docs, items):
    """id -> (n_words, n_hit, n_items, names digest, contaminated)."""
    windows = []
    for item, text in items:
        w = alnum_words(text)
        n = min(10, len(w))
        windows += [(str(item), tuple(w[i:i + n])) for i in range(len(w) - n + 1)] if w else []
    by = {}
    for item, win in windows:
        by.setdefault(win, set()).add(item)
    sizes = {len(w) for w in by}
    out = {}
    for doc, text in docs:
        w, hit, names = alnum_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = by.get(tuple(w[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(names), digest, bool(hit))
    return out


def repeated(docs, length=100):
    """id -> (n_bytes, n_removed, n_spans, kept digest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(window)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, size):
    w = spaced_words((text or "").translate(_AZ))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def near_duplicates(docs, size=2, percent=80):
    """id -> (n_shingles, component, kept), by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    holders, ids = {}, sorted(sets)
    for d in ids:
        shared = Counter()
        for s in sets[d]:
            shared.update(holders.get(s, ()))
            holders.setdefault(s, []).append(d)
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[other]) - n):
                a, b = root(d), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def base_secrets(text):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.A | re.I) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    counts = Counter(k for _, k, _ in out)
    names = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))
    return counts[0], counts[1], counts[2], hashlib.sha256(names.encode()).hexdigest()


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = spaced_words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n, covered, lines, again = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered.update((i, i + 1, i + 2))
    for line in text.split("\n"):
        if spaced_words(line):
            again += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """source -> target; sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out
