"""Plain versions of the operators, straight from their definitions."""

import collections
import hashlib
import re

import numpy as np
import regex
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LATIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def simhash(rows, bits=4):
    fps = []
    for _, t in rows:
        w = SPACED.findall(lower(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    u, of = np.array(fps, np.uint64), list(range(len(fps)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= bits):
            a, b = sorted((root(i), root(int(j))))
            of[b] = a
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[root(k)].append(i)
    low = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(i, f"{fps[k]:016x}", low[root(k)]) for k, (i, _) in enumerate(rows)]


def contamination(rows, items, window=10):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = LATIN.findall(lower(t))
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[k : k + m])].add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = LATIN.findall(lower(t)), set(), set()
        for m in {len(k) for k in wins}:
            for k in range(len(w) - m + 1):
                if own := wins.get(tuple(w[k : k + m])):
                    found |= own
                    hit.update(range(k, k + m))
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def substrings(rows, window=13):
    words = [(i, SPACED.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def measures(t):
    t = t or ""
    w = SPACED.findall(t)
    c = collections.Counter(tuple(w[p : p + 8]) for p in range(len(w) - 7))
    again = [False] * len(w)
    for p in range(len(w) - 7):
        if c[tuple(w[p : p + 8])] > 1:
            again[p : p + 8] = [True] * 8
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    n, r = len(w), sum(again)
    return n, sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(t):
    t = t or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = {
        "email": re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) if "@" in t else (),
        "ip": (m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))),
        "card": (m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": (m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15),
    }
    spans = {k: [m.span() for m in v] for k, v in found.items()}
    return (*map(len, spans.values()), sha(",".join(f"{k}:{s}:{e}" for k, v in spans.items() for s, e in v)))


def targets(sizes, max_repeat=3):
    """Sources in order with their sizes -> targets, by resharing the excess until none is above."""
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    goal, left, open_ = {}, float(sum(sizes.values())), set(sizes)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > max_repeat * sizes[s]}
        if not full:
            goal |= {s: unit * weight[s] for s in open_}
            break
        goal |= {s: float(max_repeat * sizes[s]) for s in full}
        left -= sum(max_repeat * sizes[s] for s in full)
        open_ -= full
    return goal


def pieces(vocabulary, word):
    n = 0
    while word:
        word = word[next((k for k in range(len(word), 0, -1) if word[:k] in vocabulary), 1) :]
        n += 1
    return n


def collocations(rows, words=3, support=10, inside=50, top=2000):
    """rows: (lang, text)."""
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, words + 1):
                for k in range(len(w) - n + 1):
                    f[lang, tuple(w[k : k + n])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    outer = collections.Counter()
    for (lang, p), a in found.items():
        for n in range(2, len(p)):
            for k in range(len(p) - n + 1):
                outer[lang, p[k : k + n]] = max(outer[lang, p[k : k + n]], a)
    ranked = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if 100 * outer[lang, p] >= inside * a and outer[lang, p]:
            continue
        score, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        ranked[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, k + 1, p.decode(), -a, left, right, total[lang], -s) for lang, x in ranked.items() for k, (s, a, p, left, right) in enumerate(sorted(x)[:top]))


def phrases(rows, wanted):
    """(doc_id, n_words, sorted (label, places))."""
    out = []
    for i, t in rows:
        w, by = LATIN.findall(lower(t)), collections.defaultdict(list)
        for label, phrase in wanted:
            p = phrase.split()
            by[label] += [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
        out.append((i, len(w), sorted((k, sorted(v)) for k, v in by.items() if v)))
    return out


def notices(rows, templates, more, threshold):
    """(doc_id, block, label, containment) of every stretch of a notice's
    length, the best in each block and template, without those explained by another."""
    span = max(len(LATIN.findall(t)) for t in [x[1] for x in templates] + [x[1] for x in more])
    out = set()
    for i, t in rows:
        w = LATIN.findall(lower(t))
        for b in range(-(-len(w) // span)):
            hits = []
            for label, notice, must in templates:
                seq = notice.split()
                best = max((len(set(seq) & set(w[o : o + len(seq)])), -o) if set(must.split()) <= set(w[o : o + len(seq)]) else (0, -o) for o in range(b * span, (b + 1) * span))
                if best[0] >= threshold * len(set(seq)) - 1e-9:
                    shared = set(seq) & set(w[-best[1] : -best[1] + len(seq)])
                    hits.append((label, shared, len(shared) / len(set(seq))))
            out |= {(i, b, k, round(c, 9)) for k, s, c in hits if not any(s <= s2 and (len(s2) > len(s) or c2 > c) for _, s2, c2 in hits)}
    return out


_BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_TOKEN = r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])([A-Za-z0-9]{6,})"
_BEFORE = regex.compile(r"([\p{L}_]+)([^\p{L}\p{N}_]+)\Z")


def _placed(pattern, text):
    """Matches with the word and the punctuation since the match before."""
    last = 0
    for m in re.finditer(pattern, text):
        gap = text[last : m.start()]
        tail = len(gap)
        while tail and not regex.match(r"[\p{L}\p{N}_]", gap[tail - 1]):
            tail -= 1
        start = tail
        while start and regex.match(r"[\p{L}_]", gap[start - 1]):
            start -= 1
        yield m, (gap[start:tail].lower(), gap[tail:]) if start < tail < len(gap) else ("", "")
        last = m.end()


def _sound(kind, v):
    digits = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 16 <= len(digits) <= 19 and _luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def spans(rows):
    """doc_id -> (base spans, added spans) by kind number, and the share of
    held-back values with a context that the patterns find."""
    base, tokens = {}, {}
    for i, t in rows:
        t = t or ""
        base[i] = [(n, *m.span(), m.group().lower(), c) for n, k in enumerate(_BASE) for m, c in _placed(_BASE[k], t) if _sound(k, m.group())]
        tokens[i] = []
        for m, c in _placed(f"(?:{_BASE['email']})|{_TOKEN}", t):
            if v := m.group(1):
                known = re.match(r"(?:AKIA|ASIA)[0-9A-Z]{16}\Z", v)
                key = re.search("[0-9]", v) and re.search("[A-Za-z]", v) and re.match(r"(?:[0-9a-f]{16,}|[0-9A-Z]{16,})\Z", v)
                even = xxhash.xxh64_intdigest(v.lower(), 42) % 2 == 0
                tokens[i].append((4 if known or key and even else None, *m.span(), v.lower(), c, bool(key and not known and not even)))
    edges = {}
    for k, _, _, v, c, held in [(*x, False) for b in base.values() for x in b] + [x for b in tokens.values() for x in b]:
        if c[0]:
            ks, h = edges.get((c, v), (None, True))
            edges[c, v] = (k if ks is None else ks if k is None else min(k, ks), h and held)
    seeds = {}
    for (_, v), (k, _) in edges.items():
        if k is not None:
            seeds[v] = min(k, seeds.get(v, k))
    by = collections.defaultdict(list)
    for (c, v), (_, held) in edges.items():
        by[c].append((v, held))
    belief, met = {(v, k): 1.0 for v, k in seeds.items()}, []
    while True:
        known, accepted = collections.defaultdict(dict), {}
        for (v, k), b in belief.items():
            known[v][k] = b
        for c, vs in by.items():
            decided = sum(not held or v in known for v, held in vs)
            for k in range(5):
                share = sum(known[v].get(k, 0) for v, _ in vs if v in known) / max(decided, 1)
                if len(vs) >= 5 and decided >= 3 and share >= 0.8:
                    accepted[c, k] = share
        if set(accepted) in met:
            break
        met.append(set(accepted))
        doubt = collections.Counter()
        for (c, k), share in accepted.items():
            for v, _ in by[c]:
                if v not in seeds:
                    doubt[v, k] += np.log(max(1 - share, 1e-6))
        belief = {(v, k): 1.0 for v, k in seeds.items()} | {vk: 1 - np.exp(d) for vk, d in doubt.items()}
    out, held_back, hit = {}, set(), set()
    for i, _ in rows:
        added = set()
        for k, s, e, v, c, held in tokens[i]:
            kinds = {n for p, n in accepted if p == c} | ({k} if k is not None else set())
            if any(b[1] < e and b[2] > s for b in base[i]):
                continue
            added |= {(n, s, e) for n in kinds}
            if held and c[0]:
                held_back.add(v)
                hit |= {v} if kinds else set()
        out[i] = (sorted(b[:3] for b in base[i]), sorted(added))
    return out, len(hit) / max(len(held_back), 1)
