"""Plain definitions of the operators, for small inputs."""

import bisect
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text):
    return WORD.findall(text or "")


def lines(rows, num=4, den=5):
    """[(doc_id, text)] sorted -> {doc_id: (n_lines, n_removed, n_links, kept text)}; ids differ."""
    first = {}
    for k, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if words(line):
                first.setdefault(frozenset(words(line)), (k, i))
    sets, links, later = list(first), Counter(), set()
    for i, x in enumerate(sets):
        for y in sets[i + 1:]:
            c = len(x & y)
            if den * c >= num * (len(x) + len(y) - c):
                links[x] += 1
                links[y] += 1
                later.add(max((x, y), key=first.get))
    out = {}
    for k, t in rows:
        kept, n, gone, own = [], 0, 0, 0
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(words(line))
            n += bool(s)
            if s and first[s] == (k, i):
                own += links[s]
            if s and (first[s] != (k, i) or s in later):
                gone += 1
            else:
                kept.append(line)
        out[k] = (n, gone, own, t if not gone else "\n".join(kept))
    return out


def windows(rows, size=20):
    """[(doc_id, text)] sorted -> {doc_id: (n_words, n_removed, kept text)}."""
    seen, out = set(), {}
    for k, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            x = tuple(w[i:i + size])
            if x in seen:
                gone[i:i + size] = [True] * size
            seen.add(x)
        out[k] = (len(w), sum(gone), " ".join(a for a, b in zip(w, gone) if not b))
    return out


def contamination(text, items, size=10):
    """(n_words, hit word numbers, items met)."""
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, met = find(text), set(), set()
    for item, t in items:
        v = find(t)
        n = min(size, len(v))
        parts = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in parts:
                hit |= set(range(i, i + n))
                met.add(str(item))
    return len(w), sorted(hit), sorted(met)


def quality(text):
    t = text or ""
    w = words(t)
    own = [x for x in t.split("\n") if words(x)]
    count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            cover[i:i + 8] = [True] * 8
    n = sum(cover)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(own) - len(set(own)), n, len(w) < 20 or 100 * n > 30 * len(w))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    """Base spans (kind, start, end) by start, then kind."""
    t, out = text or "", []
    for k, (kind, pattern) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits) \
                    or kind == "phone" and 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


def fingerprint(text, n=3):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, distance=2):
    """{id: fingerprint} -> {id: smallest id reachable}."""
    ids = sorted(prints)
    root = {k: k for k in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def kneser_ney(train, discounts):
    """p(word, word before) of the bigram model, and counts (c, N, V), from token lists without their ends."""
    seqs = [t + ["</s>"] for t in train]
    uni = Counter(w for t in seqs for w in t)
    pairs = Counter(p for t in seqs for p in zip(["<s>"] + t, t))
    ctx, follow, cont = Counter(), defaultdict(Counter), Counter()
    for (h, w), c in pairs.items():
        ctx[h] += c
        follow[h][min(c, 3)] += 1
        cont[w] += 1
    d = discounts([sum(v == k for v in pairs.values()) for k in (1, 2, 3, 4)])
    low = discounts([sum(v == k for v in cont.values()) for k in (1, 2, 3, 4)])
    rest = sum(low[min(c, 3)] for c in cont.values()) / len(pairs) if pairs else 1.0

    def p(w, h):
        c = cont.get(w, 0)
        lower = max(c - low[min(c, 3)], 0) / max(len(pairs), 1) + rest / (len(uni) + 1)
        if h not in ctx:
            return lower
        c = pairs.get((h, w), 0)
        return max(c - d[min(c, 3)], 0) / ctx[h] + sum(d[k] * n for k, n in follow[h].items()) / ctx[h] * lower
    return p, uni


def area(score, label):
    """Area under the ROC curve."""
    score, label = np.array(score), np.array(label)
    a, b = score[label == 1], score[label == 0]
    return float((a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean())


def alignment(texts, a_of, b_of, a_bytes, b_bytes):
    """[text] -> [(n_a, n_b, n_groups, n_links, n_best, count_sum, groups)], token by token."""
    from collections import Counter
    rows, count = [], Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        a, b = (a_of(" " + t), b_of(t)) if t else ([], [])
        if not t or b"".join(a_bytes[x] for x in a) != whole or b"".join(b_bytes[x] for x in b) != whole:
            rows.append(([], [], []))
            continue
        ends = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for x in ids:
                at += len(size[x])
                own.append(at)
            ends.append(own)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in both]
        for side, ids in enumerate((a, b)):
            for x, e in zip(ids, ends[side]):
                groups[bisect.bisect_left(both, e)][side].append(x)
        links = [(x, y) for x, e in zip(a, ends[0]) for y, f in zip(b, ends[1]) if e == f] if len(a) < 60 else [(g[-1], h[-1]) for g, h in groups]
        count.update(links)
        rows.append((a, b, groups, links))
    most = Counter()
    for (x, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for r in rows:
        a, b, groups, links = (*r, [])[:4] if len(r) == 3 else r
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
                    ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, best=10):
    """docs [(id, text)], items [(id, text)] -> [(item, rank, id, score)], every document for every item."""
    import math
    bags = [(k, Counter(w.translate(LOWER) for w in TERM.findall(t or ""))) for k, t in docs]
    bags = [(k, b) for k, b in bags if b]
    n_docs, n_terms, df = len(bags), sum(sum(b.values()) for _, b in bags), Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scored = []
        for k, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * b[w]) // (1000 * b[w] + 8 * m))
                    for w in {w.translate(LOWER) for w in TERM.findall(text or "")} if b[w])
            if s > 0:
                scored.append((-s, k is None, k))
        out += [(item, r + 1, k, -s) for r, (s, _, k) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:best])]
    return out


def ngram_sets(texts, size=4):
    out = []
    for t in texts:
        w = [x.translate(LOWER) for x in words(t)]
        out.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def ngram_components(rows, num=85, den=100, size=4):
    """[(doc_id or None, text)] -> [(doc_id, n, component)], all pairs compared."""
    sets = ngram_sets([t for _, t in rows], size)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and den * len(x & sets[j]) >= num * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))]
