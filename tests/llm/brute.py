"""Plain versions of the corpus operators, for small tables."""
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_statistics(text):
    w = words(text)
    shingles = list(zip(w, w[1:], w[2:]))
    seen, covered = Counter(shingles), set()
    for i, s in enumerate(shingles):
        if seen[s] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def fingerprint(text, k=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def components(fps, bits):
    """{id: code} -> {id: least id linked at ``bits`` or fewer differences}."""
    u, items = Union(fps), sorted(fps.items())
    for n, (i, a) in enumerate(items):
        for j, b in items[n + 1:]:
            if (a ^ b).bit_count() <= bits:
                u.join(i, j)
    return {i: u.root(i) for i in fps}


def substring_dedup(docs, length):
    """[(id, text)] -> the kept words of each row; ids may repeat or be None."""
    first = {}
    for d, text in docs:
        w = words(text)
        for i in range(len(w) - length + 1) if d is not None else ():
            s = tuple(w[i:i + length])
            first[s] = min(first.get(s, d), d)
    out = []
    for d, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - length + 1) if d is not None else ():
            if first[tuple(w[i:i + length])] < d:
                gone |= set(range(i, i + length))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def runs(w, exponent=4, shortest=6):
    """(start, length, period) of every run of ``w``, by start, then period."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, n = i, j + q - i
            if j > i and n >= max(shortest, exponent * q) and not any(
                    all(w[x] == w[x + p] for x in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(items, length):
    """[(item, words)] -> {window: items}"""
    out = {}
    for item, w in items:
        for i in range(max(len(w) - length + 1, 1) if w else 0):
            out.setdefault(tuple(w[i:i + length]), set()).add(item)
    return out


def phrases(docs, most):
    """[(lang, text)] -> counts of (lang, words) up to ``most`` words, words per language."""
    counts, total = Counter(), Counter()
    for lang, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    return counts, total


def collocations(docs, least, most, percent):
    """Rows (lang, phrase, a, l, r, n, score) without those a longer phrase absorbs."""
    counts, total = phrases(docs, most)
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = set()
    for (lang, w), a in found.items():
        if any(100 * b >= percent * a for (other, v), b in found.items()
               if other == lang and len(v) > len(w)
               and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k)
                for k in range(1, len(w))]
        score, k = min(cuts)
        out.add((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], total[lang], score))
    return out
