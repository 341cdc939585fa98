"""Brute-force versions of the operators' contracts, over Python lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is None, r[1] or ""))


def substring_dedup(rows, width=20):
    seen, out = set(), []
    for i, text in ordered(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            window = tuple(words[s:s + width])
            if window in seen:
                gone[s:s + width] = [True] * width
            seen.add(window)
        out.append((i, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def byte_dedup(rows, width=400):
    count = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        count.update(b[s:s + width] for s in range(len(b) - width + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for s in range(len(b) - width + 1):
            if count[b[s:s + width]] > 1:
                gone[s:s + width] = [True] * width
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) >= 5:
        return {tuple(words[j:j + 5]) for j in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def near_duplicates(rows, percent=75):
    """{doc_id: (n_shingles, component)} of rows with distinct, non-null ids."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, both in Counter(j for x in sets[i] for j in holders[x] if j < i).items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def quality_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def unigram_scores(rows):
    """[(doc_id, n_tokens, n_known, train_tokens, base_score)]"""
    tokens = [(i, (t or "").encode().translate(LOWER).split() + [None]) for i, t in rows]
    count = Counter()
    for i, words in tokens:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(words)
    n, v = sum(count.values()), len(count)
    return [(i, len(w), sum(count[x] > 0 for x in w), n,
             sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for i, w in tokens]


def quantised(count):
    """The middle of the range of counts that share a level: ranges of one at first, then growing by a quarter."""
    if not count:
        return 0.0
    low = 1
    while True:
        above = max(low + 1, math.ceil(low * 1.25))
        if count < above:
            return (low + above - 1) / 2
        low = above


def model_scores(rows, learns):
    """[(doc_id, score)] of the mixture of pair and word shares, from exact counts quantised."""
    start, end = "start", "end"  # words are bytes, so these are none
    tokens = [(i, (t or "").encode().translate(LOWER).split() + [end]) for i, t in rows]
    words, pairs, texts = Counter(), Counter(), 0
    for i, w in tokens:
        if learns(i):
            texts += 1
            words.update(w)
            pairs.update(zip([start, *w], w))
    floor = sum(words.values()) + 0.5 * (len(words) + 1)
    out = []
    for i, w in tokens:
        total = 0.0
        for before, word in zip([start, *w], w):
            history = quantised(texts if before == start else words[before])
            weight = 0.5 * history / (history + 2.0)
            paired = min(quantised(pairs[before, word]), history) / max(history, 1)
            total += math.log10(weight * paired + (1 - weight) * (quantised(words[word]) + 0.5) / floor)
        out.append((i, total))
    return out
