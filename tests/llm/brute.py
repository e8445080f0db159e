"""Plain versions of the operators, a row at a time, for small tables."""
import hashlib
import re
import zlib
from collections import Counter
from math import log

import numpy as np
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def tokens(rows, tokenizer):
    """(id, start, n, crc) in id order, null first; equal ids in any order."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def targets(sizes, weights, share, most):
    """Reshares the excess over and over, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def contamination(rows, items, window):
    phrases = {}
    for item, text in items:
        words = PLAIN.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[i : i + window]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    out = []
    for doc, text in rows:
        words = PLAIN.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (p := tuple(words[i : i + n])) in phrases:
                    hit |= set(range(i, i + n))
                    found |= phrases[p]
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def fingerprint(text, shingle=3):
    words = SPACED.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, max_bits, shingle=3):
    """(id, hex, least id reachable) by comparing all pairs."""
    fps = [(doc, fingerprint(text, shingle)) for doc, text in rows]
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    raw = np.array([f for _, f in fps], np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(raw[i] ^ raw[i + 1 :]) <= max_bits):
            parent[root(i)] = root(int(i + 1 + j))
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, f"{fp:016x}", least.get(root(i))) for i, (doc, fp) in enumerate(fps)]


def repeats(rows, length):
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for doc, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(b)]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((doc, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def quality(rows, limits, line_limit):
    out = []
    for doc, text in rows:
        text = text or ""
        words = SPACED.findall(text)
        chars = [len(w) for w in words]

        def covered(n, words=words, repeats_only=False):
            seen, count, inside = set(), Counter(), [False] * len(words)
            grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
            count.update(grams)
            for i, g in enumerate(grams):
                if g in seen if repeats_only else count[g] > 1:
                    inside[i : i + n] = [True] * n
                seen.add(g)
            return inside

        lines, before, dup, dup_chars = text.split("\n"), set(), 0, 0
        for line in lines:
            own = SPACED.findall(line)
            if own and line in before:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, own))
            before.add(line)
        total = sum(chars)
        n_repeat = sum(covered(3))
        failed = len(words) < 50 or 100 * n_repeat > 50 * len(words)
        kept = not failed and dup_chars / max(total, 1) <= line_limit
        for n, limit in limits.items():
            kept = kept and sum(c for c, x in zip(chars, covered(n, repeats_only=True)) if x) / max(total, 1) <= limit
        out.append((doc, len(words), total, sum(c in "#*$%&|<>" for c in text), dup, n_repeat, failed, kept))
    return out


def lm(rows, order, backoff):
    docs = [[w for w in SPACED.findall(lower(t))] for _, t in rows]
    own = [[Counter(tuple(d[i : i + n]) for i in range(len(d) - n + 1)) for n in range(1, order + 1)] for d in docs]
    total = [sum((o[n] for o in own), Counter()) for n in range(order)]
    words = sum(map(len, docs))
    out = []
    for (doc, _), d, o in zip(rows, docs, own):
        score, stepped = 0.0, 0
        count = lambda g, o=o: total[len(g) - 1][g] - o[len(g) - 1][g]
        for i, w in enumerate(d):
            down = 0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(d[i - n + 1 : i + 1])
                if n == 1:
                    score += log((count(gram) + 1) / (words - len(d) + 2)) + down * log(backoff)
                elif count(gram) > 0:
                    score += log(count(gram) / count(gram[:-1])) + down * log(backoff)
                    break
                else:
                    down += 1
            stepped += down > 0
        out.append((doc, len(d), score, stepped))
    return out


def search(rows, items, k):
    """(item, rank, doc, score), every document scored for every item."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(doc, Counter(term.findall(lower(text)))) for doc, text in rows]
    docs = [(doc, tf, sum(tf.values())) for doc, tf in docs if tf]
    df = Counter(t for _, tf, _ in docs for t in tf)
    every, out = sum(n for *_, n in docs), []
    for item, text in items:
        scores = []
        for doc, tf, n in docs:
            m = 10 + (90 * n * len(docs)) // every
            score = sum(int(1000 * log((2 * len(docs) + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in set(term.findall(lower(text))) if t in tf)
            if score:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -score) for i, (score, none, doc) in enumerate(sorted(scores)[:k])]
    return out


def lines(rows, min_chars, min_docs):
    def key(line):
        return lower(line.strip(" \t\n\x0b\f\r"))

    held = {}
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            held.setdefault(k, []).append(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = []
        for line in all_lines:
            docs = held[k := key(line)]
            owner = max((d for d in docs if d is not None), default=None)
            if len(k) < min_chars or len(docs) < min_docs or doc == owner:
                kept.append(line)
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


def trie(rows, cycle=20, shared=4):
    """Nodes of rebuilt conversations, by walking every prefix; rows (conv, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(r, key=lambda t: t[:2])] for c, r in own.items()}
    members = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % shared
        base = c - int(np.fmod(c, cycle))
        rebuilt = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(rebuilt) + 1):
            members.setdefault(tuple(rebuilt[:d]), []).append((c, len(rebuilt)))
    kids = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        words = len(SPACED.findall(s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * words
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in m if n == len(s)))
        parent = min(c for c, _ in members[s[:-1]]) if s else None
        out.append((min(c for c, _ in m), len(s), parent, len(m), kids[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return out
