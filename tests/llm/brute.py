"""The operators' results by their definitions, in plain Python; None texts count as empty."""

import hashlib
import math
import re
import zlib
from collections import Counter

LOWER = {65 + i: 97 + i for i in range(26)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode("utf-8") if isinstance(text, str) else text).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def licenses(text, phrases):
    w = words(text)
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secrets(text):
    text = text or ""
    assign = re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    counts = Counter(k for _, k, _ in spans)
    return counts[0], counts[1], counts[2], sha(listed)


def substrings(docs, length):
    """By document: bytes, removed, runs, hash of the rest."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            part = raw[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), runs, sha(kept))
    return out


def held_out(doc, modulus, rest):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == rest


def base_scores(docs):
    """By row: held out, tokens, known, training tokens, score."""
    counts = Counter()
    for doc, text in docs:
        if not held_out(doc, 7, 2):
            counts.update([*tokens(text), None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc, text in docs:
        own = [*tokens(text), None]
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        out.append((doc, held_out(doc, 7, 2), len(own), sum(w in counts for w in own), total, round(score, 6)))
    return out


def quality(text):
    text = text or ""
    w = TOKEN.findall(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if TOKEN.search(line)]
    n, repeated = len(w), len(inside)
    failed = n < 10 or 100 * repeated > 20 * n
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), repeated, failed


def shingle_set(text, width):
    w = tokens(text)
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def linked(docs, width, percent):
    """By document (ids without null): set size and smallest reachable id."""
    sets = [(doc, shingle_set(text, width)) for doc, text in docs]
    parent = {doc: doc for doc, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {doc: (len(s), find(doc)) for doc, s in sets}


def suffix_tree_scores(texts, trains, prior=20.0, gain=2.0, least=2):
    """log10 probabilities of each text's tokens: contexts as tuples, by length, in plain dictionaries."""
    rows = [[None, *tokens(t), None] for t in texts]
    words = Counter(w for r, t in zip(rows, trains) if t for w in r[1:])
    floor = sum(words.values()) + len(words) + 1
    scores = [[(words[w] + 1) / floor for w in r[1:]] for r in rows]
    places = [(i, j) for i, r in enumerate(rows) for j in range(1, len(r)) if words[r[j - 1]] >= least]
    seen, length = {(w,): n for w, n in words.items()}, 1
    while places:
        grams = Counter(tuple(rows[i][j - length : j + 1]) for i, j in places if trains[i])
        gains = Counter()
        for i, j in places:
            if trains[i]:
                gram, p = tuple(rows[i][j - length : j + 1]), scores[i][j - 1]
                gains[gram[:-1]] += math.log((grams[gram] - 1 + prior * p) / (seen[gram[:-1]] - 1 + prior) / p)
        looked, after = set(places), []
        for i, j in places:
            gram = tuple(rows[i][j - length : j + 1])
            if gains[gram[:-1]] > gain:
                scores[i][j - 1] = (grams[gram] + prior * scores[i][j - 1]) / (seen[gram[:-1]] + prior)
                if (i, j - 1) in looked and grams[tuple(rows[i][j - 1 - length : j])] >= least:
                    after.append((i, j))
        places, seen, length = after, grams, length + 1
    return [[math.log10(p) for p in s] for s in scores]
