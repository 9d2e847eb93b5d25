"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import math
import re
import struct
from collections import Counter

import regex
import xxhash

WORD = re.compile(r"[^ \t-\r]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def components(n, linked):
    """Smallest index reachable, given a symmetric predicate on indices."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal(t):
    """(kind, start, end) of the base spans, kind by kind."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def figures(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD.findall(t or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def _signed(h):
    return struct.unpack("<q", struct.pack("<Q", h))[0]


def buckets(t, bits=16):
    toks = regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+", t or "")
    one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in toks]
    two = [xxhash.xxh64_intdigest(y.encode(), h) for h, y in zip(one, toks[1:])]
    return [_signed(h) % (1 << bits) for h in one + two]


def likelihood_ratios(texts, good, alpha=8.0):
    """Mean log ratio of each text; ``good``: whether it is in the trusted set."""
    grams = [buckets(t) for t in texts]
    raw, target = Counter(), Counter()
    for g, ok in zip(grams, good):
        raw.update(g)
        if ok:
            target.update(g)
    n, m = sum(raw.values()), sum(target.values())
    if not m:
        return [0.0] * len(texts)
    weight = {b: math.log((target[b] + alpha) / (c * (m / n) + alpha)) for b, c in raw.items()}
    return [sum(weight[b] for b in g) / max(1, len(g)) for g in grams]


def fingerprint(t, k=3):
    words = WORD.findall(lower(t))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def secrets(t):
    out = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def context_tree(train, tests, depth):
    """log10 probabilities by context-tree weighting, from the definition."""
    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def bits(words):
        s = b"\n" * depth + b" ".join(words) + b"\n"
        for i in range(depth, len(s)):
            for k in range(8):
                yield s[i - depth : i], (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1

    counts, below, log = {}, Counter(), {}
    for words in train:
        for context, node, bit in bits(words):
            for d in range(depth + 1):
                counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = kt(*counts[key])
        if len(key[0]) == depth:
            log[key] = own
        else:
            high, low = max(own, below[key]), min(own, below[key])
            log[key] = high + math.log1p(math.exp(low - high)) - math.log(2)
        if key[0]:
            below[key[0][1:], key[1]] += log[key]

    def predict(context, node, d):
        key = (context[depth - d :], node)
        if key not in counts:
            return 0.5
        a, b = counts[key]
        own = (b + 0.5) / (a + b + 1)
        if d == depth:
            return own
        share = 1 / (1 + math.exp(min(700, below[key] - kt(a, b))))
        return share * own + (1 - share) * predict(context, node, d + 1)

    return [sum(math.log10(p if bit else 1 - p) for c, n, bit in bits(w) for p in [predict(c, n, 0)]) for w in tests]


def collocations(rows, support, contained=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    cands = {x: a for x, a in count.items() if len(x[1]) > 1 and a >= support}
    dropped = set()
    for (lang, p), a in cands.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= contained * cands[lang, p[i : i + k]]:
                    dropped.add((lang, p[i : i + k]))
    out = []
    for lang in {x[0] for x in cands}:
        scored = []
        for (own, p), a in cands.items():
            if own == lang and (lang, p) not in dropped:
                cuts = [(2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p))]
                score, _, l, r = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def divergence(rows, min_docs, top):
    """(lang, source, part, item, value, rank) of rows (lang, source, text)."""
    docs, count = Counter(), Counter()
    rows = [tuple(x or "" for x in r) for r in rows]
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    groups = sorted({(lang, source) for lang, source, _ in rows})
    for lang in {g[0] for g in groups}:
        kept = [t for own, t in docs if own == lang and docs[own, t] >= min_docs]
        sources = [s for own, s in groups if own == lang]
        counts = {s: [count[lang, s, t] for t in kept] for s in sources}
        whole = [sum(x) for x in zip(*counts.values())]

        def shares(c):
            return [1 + 10**9 * (x + 5) // (sum(c) + 5 * len(kept)) for x in c]

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in sources:
            far = sorted((-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -v, r) for r, (v, o) in enumerate(far, 1)]
            more = sorted((b - a, t.encode()) for t, c, a, b in zip(kept, counts[s], p[s], q) if c and a > b)[:top]
            out += [(lang, s, "term", t.decode(), -v, r) for r, (v, t) in enumerate(more, 1)]
    return sorted(out)


def top_vectors(rows, k, every, scale=256):
    """(query_id, rank, vec_id, score) of rows (id, vector)."""
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * x) for x in v]

    rows = [(i, w) for i, v in rows if (w := whole(v)) is not None]
    out = []
    for n, (i, v) in enumerate(rows):
        if i is not None and i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for m, (j, w) in enumerate(rows) if m != n and len(w) == len(v)]
            out += [(i, r, None if none else j, -s) for r, (s, none, j, _) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def language(train, texts, smoothing=0.5):
    """(language, share) of each text, learnt from rows (lang, text)."""
    def words(t):
        return regex.findall(r"\p{L}+", (t or "").lower())

    def grams(w):
        w = f"^{w}$"
        return [w[i : i + k] for k in range(1, 5) for i in range(len(w) - k + 1)]

    langs = sorted({x for x, _ in train if x is not None})
    one, two = Counter(), Counter()
    for lang, t in train:
        if lang is not None:
            for w in words(t):
                one[lang, w] += 1
                two.update((lang, g) for g in grams(w))

    def logs(count):
        known = {x for _, x in count}
        total = {lang: sum(n for (own, _), n in count.items() if own == lang) for lang in langs}
        return {x: [math.log((count[lang, x] + smoothing) / (total[lang] + smoothing * len(known))) for lang in langs] for x in known}

    by_word, by_gram = logs(one), logs(two)

    def score(w):
        if w in by_word:
            return by_word[w]
        for k in range(4, 0, -1):
            found = [by_gram[g] for g in grams(w) if len(g) == k and g in by_gram]
            if found:
                return [sum(c) / len(found) for c in zip(*found)]
        return [0.0] * len(langs)

    out = []
    for t in texts:
        found = words(t)
        if not found or not langs:
            out.append(("und", 0.0))
            continue
        total = [sum(c) for c in zip(*map(score, found))]
        best = max(total)
        out.append((langs[total.index(best)], 1 / sum(math.exp(x - best) for x in total)))
    return out


def plain_em(votes, start, rounds, smooth):
    """Two-class EM over single candidates: ``votes`` lists each candidate's votes, ``start[j][y][v]`` the first (and prior)
    distributions. Returns the share of class 1 and each candidate's posterior."""
    theta, share, post = start, 0.5, []
    for _ in range(rounds):
        post = []
        for row in votes:
            like = [1 - share, share]
            for y in (0, 1):
                for j, v in enumerate(row):
                    like[y] *= theta[j][y][v]
            post.append(like[1] / sum(like))
        share = (sum(post) + 1) / (len(post) + 2)
        theta = [{y: {v: (smooth * start[j][y][v] + sum((q if y else 1 - q) for row, q in zip(votes, post) if row[j] == v))
                      / (smooth + sum(q if y else 1 - q for q in post)) for v in (-1, 0, 1)} for y in (0, 1)}
                 for j in range(len(start))]
    return share, post
