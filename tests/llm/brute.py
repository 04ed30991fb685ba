"""Plain definitions of the results, for small inputs."""

import collections
import hashlib
import re

import numpy as np
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def windows(items, size=10):
    out = collections.defaultdict(set)
    for name, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            out[tuple(w[k : k + n])].add("" if name is None else str(name))
    return out


def contaminated(docs, items):
    grams = windows(items)
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, who = set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if found := grams.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    who |= found
        out.append((doc_id, len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)))
    return out


def fingerprint(text):
    w = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(v >> i & 1 for v in values) > len(values))


def components(fps, radius=3):
    """Component number of each fingerprint."""
    f, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def near_copies(rows, shingle=5):
    """The least id of each component of texts at a similarity of 0.8 or more, None last, and the linked pairs of rows."""
    sets = []
    for _, t in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        sets.append({" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))})
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent, pairs = list(range(len(rows))), []

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        both = collections.Counter(j for x in a for j in holders[x] if j < i)
        for j, n in both.items():
            if 5 * n >= 4 * (len(a) + len(sets[j]) - n):
                pairs.append((i, j))
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), (True, 0)), (d is None, d or 0))
    return [None if n else d for n, d in least.values()], pairs


def without_repeats(rows, length=100):
    """Multiset of (doc_id, n_bytes, n_removed, n_spans, sha256); None sorts first."""
    order = lambda d: (d is not None, d if d is not None else 0)
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            at = (order(d), i)
            s = b[i : i + length]
            least[s] = min(least.get(s, at), at)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < (order(d), i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def counts(text):
    text = text or ""
    w = SPACED.findall(text)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


def without_boilerplate(rows, min_sites=5):
    sites = collections.defaultdict(set)
    for _, source, text in rows:
        for line in (text or "").split("\n") if text is not None and source is not None else ():
            if line.strip(" \t\r"):
                sites[line].add(source)
    out = []
    for doc_id, _, text in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if len(sites.get(x, ())) < min_sites]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def _sound(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def _last(i):
    return (i is None, i or 0)


def codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error, label_error, codebooks_sha256) of the kept rows of (id, vector, label)."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v], n) for i, v, n in rows if _sound(v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), n) for i, v, n in kept]
    first = {}
    for i, v, _ in kept:
        first[i] = min(first.get(i, v), v)
    seeds = [first[i] for i in sorted(first, key=_last)[:entries]]
    x = np.array([v for _, v, _ in kept], object).reshape(len(kept), parts, width)
    book = np.array(seeds, object).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    def nearest(p):
        far = ((x[:, p, None, :] - book[p][None]) ** 2).sum(2)
        at = [min(range(len(r)), key=lambda j: (r[j], j)) for r in far]
        return np.array(at), np.array([r[j] for r, j in zip(far, at, strict=True)], object)

    for _ in range(rounds):
        for p in range(parts):
            at, _far = nearest(p)
            for e in set(at.tolist()):
                own = x[at == e, p]
                book[p, e] = own.sum(0) // len(own)
    found = [nearest(p) for p in range(parts)]
    errors = [int(sum(far[k] for _, far in found)) for k in range(len(kept))]
    total = collections.Counter()
    for (_, _, n), e in zip(kept, errors, strict=True):
        total[n] += e
    sha = hashlib.sha256(",".join(str(int(v)) for v in book.reshape(-1)).encode()).hexdigest()
    return [(i, "".join(f"{at[k]:02x}" for at, _ in found), errors[k], total[n], sha) for k, (i, _, n) in enumerate(kept)]


def negatives(rows, is_anchor, positives=5, wanted=10):
    """(anchor, positive, rank, negative, scores) of rows (id, whole-number vector, label)."""
    kept = [r for r in rows if r[2] is not None and _sound(r[1])]
    width = max((len(v) for _, v, _ in kept), default=0)
    x = [[int(c) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    out = []
    for a, (name, _, label) in enumerate(kept):
        if not is_anchor(name):
            continue
        s = [sum(p * q for p, q in zip(x[a], y, strict=True)) for y in x]
        order = sorted(range(len(kept)), key=lambda j: (-s[j], _last(kept[j][0])))
        for p in [j for j in order if j != a and kept[j][2] == label][:positives]:
            window = [j for j in order if kept[j][2] != label and 30 * s[p] <= 100 * s[j] <= 90 * s[p]]
            out += [(name, kept[p][0], k + 1, kept[j][0], s[p], s[j]) for k, j in enumerate(window[:wanted])]
    return out
