"""Plain Python versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = True) -> list[bytes]:
    return ((text or "").translate(LOWER) if lower else text or "").encode().split()


def held_out(doc_id: int | None, modulus: int) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % modulus == 2


def line_dedup(docs: list[tuple], min_docs: int = 3, min_chars: int = 20) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept_sha256) of (doc_id, text)."""
    def key(line: str) -> str:
        return line.strip(SPACES).translate(LOWER)

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(key(line), ())
            if len(held) < min_docs or max((d for d in held if d is not None), default=None) == doc_id:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard_components(docs: list[tuple], n: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text)."""
    sets, root = [shingles(t, n) for _, t in docs], list(range(len(docs)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        common = Counter(other for x in s for other in holders[x])
        for other, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                root[find(k)] = find(other)
        for x in s:
            holders[x].append(k)
    members = defaultdict(list)
    for k in range(len(docs)):
        members[find(k)].append(k)
    lowest = {r: min((docs[k][0] for k in ks if docs[k][0] is not None), default=None) for r, ks in members.items()}
    return [(d, len(sets[k]), lowest[find(k)]) for k, (d, _) in enumerate(docs)]


def targets(sizes: dict[str | None, int], weights=(3, 1, 2), share=1.5, most=2) -> dict[str | None, float]:
    """Words each source should give: shared by weight, what is above a cap shared anew, until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed: dict = {}
    while True:
        left, rest = share * sum(sizes.values()) - sum(fixed.values()), [s for s in order if s not in fixed]
        rate = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if rate * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: rate * weight[s] for s in rest}
        fixed |= {s: most * sizes[s] for s in over}


def rule_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w, seen, dup = words(text, lower=False), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def base_scores(docs: list[tuple]) -> list[tuple]:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of (doc_id, text)."""
    tokens = [[*words(t), "end"] for _, t in docs]
    counts = Counter(t for (d, _), ts in zip(docs, tokens, strict=True) if not held_out(d, 7) for t in ts)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, held_out(d, 7), len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        for (d, _), ts in zip(docs, tokens, strict=True)]


def repeats(docs: list[tuple], length: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    texts = [(t or "").encode() for _, t in docs]
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), text in zip(docs, texts, strict=True):
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if times[text[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance_within(pattern: list, text: list) -> int:
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1)
    return min(row)


def passages(docs: list[tuple], size: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text): words in a window that a smaller doc_id has, too."""
    texts = [words(t, lower=False) for _, t in docs]
    first: dict[tuple, int] = {}
    for (doc_id, _), w in zip(docs, texts, strict=True):
        for i in range(len(w) - size + 1 if doc_id is not None else 0):
            window = tuple(w[i:i + size])
            first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for (doc_id, _), w in zip(docs, texts, strict=True):
        lost = set()
        for i in range(len(w) - size + 1 if doc_id is not None else 0):
            if first[tuple(w[i:i + size])] < doc_id:
                lost |= set(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in lost)
        out.append((doc_id, len(w), len(lost), hashlib.sha256(kept).hexdigest()))
    return out


def divergence(docs: list[tuple], min_docs: int, top: int = 10) -> list[tuple]:
    """(lang, source, part, item, value, rank) of (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    groups, holders = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = []
    for lang in holders.keys() | {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= min_docs]
        own = {s: c for (l, s), c in groups.items() if l == lang}

        def shares(count: Counter, kept: list[str] = kept) -> dict[str, int]:
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def gap(p: int, q: int) -> int:
            return (p - q) ** 2 // (p + q)

        of, whole = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        for s, p in of.items():
            lists = {"pair": [(sum(gap(p[t], q[t]) for t in kept), o) for o, q in of.items() if o != s],
                     "term": [(gap(p[t], whole[t]), t) for t in kept if own[s][t] and p[t] > whole[t]]}
            for part, found in lists.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                found = found[:top] if part == "term" else found
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1)]
    return out


def manifest(docs: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text)."""
    def h(*parts: str) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(row: tuple) -> str:
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes: list[str]) -> list[list[str]]:
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([h(*found[-1][k:k + 3]) for k in range(0, len(found[-1]), 3)])
        return found

    def climb(found: list[list[str]], k: int, node: str, siblings: list[str]) -> str:
        for nodes in found[:-1]:
            run, at = nodes[k - k % 3:k - k % 3 + 3], k % 3
            siblings += run[:at] + run[at + 1:]
            node, k = h(*run[:at], node, *run[at + 1:]), k // 3
        return node

    rows = sorted(docs, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append(r)
    trees = {s: tree([leaf(r) for r in rs]) for s, rs in by_source.items()}
    top = tree([t[-1][0] for t in trees.values()])
    out = []
    for place, (s, rs) in enumerate(by_source.items()):
        for k, r in enumerate(rs):
            spoilt = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            given = leaf((*r[:4], r[4].replace("\n", ""))) if spoilt else leaf(r)
            siblings: list[str] = []
            end = climb(top, place, climb(trees[s], k, given, siblings), siblings)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*siblings), end, end == top[-1][0]))
    return out
