"""Plain Python versions of the operators, over {key: text}."""

import bisect
import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def repeats(texts: dict, least: int = 400) -> dict:
    """n_bytes, n_removed, n_spans, kept_sha256."""
    raw = {i: t.encode() for i, t in texts.items()}
    seen = collections.Counter(b[k : k + least] for b in raw.values() for k in range(len(b) - least + 1))
    out = {}
    for i, b in raw.items():
        covered = np.zeros(len(b), bool)
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                covered[k : k + least] = True
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(b, "u1")[~covered])
        out[i] = len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()
    return out


def quality(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = WORD.findall(text.encode())
    windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    repeated = set()
    for k in range(len(w) - 4):
        if windows[tuple(w[k : k + 5])] > 1:
            repeated.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x.encode())]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def licenses(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def exact(texts: dict) -> dict:
    """keep_id, group_size, kept, text_sha256; keys are doc ids."""
    groups = collections.defaultdict(list)
    for i, t in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    return {i: (min(v), len(v), i == min(v), hashlib.sha256(t.encode()).hexdigest()) for t, v in groups.items() for i in v}


def shingles(text: str) -> collections.Counter:
    w = text.encode().split()
    return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()


def near(texts: dict, least: float = 0.8) -> dict:
    """Smallest id of every document's class: connected components of pairs of weighted Jaccard ``least`` or more."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    pairs = {(a, b) for v in holders.values() for a in v for b in v if a < b}
    for a, b in pairs:
        if sum((sets[a] & sets[b]).values()) >= least * sum((sets[a] | sets[b]).values()):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def base_scores(texts: dict) -> dict:
    """held_out, n_tokens, n_known, train_tokens, base_score."""
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i in texts}
    words = {i: t.encode().lower().split() for i, t in texts.items()}
    counts = collections.Counter(w for i in texts if not held[i] for w in words[i])
    ends = sum(not h for h in held.values())
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = {}
    for i in texts:
        c = [counts[w] for w in words[i]] + [ends]
        out[i] = (held[i], len(c), sum(x > 0 for x in c), total, sum(math.log10((x + 0.5) / (total + 0.5 * (distinct + 1))) for x in c))
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter was inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_words(texts: list[tuple]) -> dict:
    """Words with their occurrences, of (doc_id, text) rows."""
    found = collections.Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            found[low] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def spelling_groups(words: dict, times: int = 10) -> dict:
    """form, root, n, n_near, form_n by word."""
    near = collections.defaultdict(list)
    for w in words:
        for other in words:
            if one_edit(w, other):
                near[w].append(other)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def alignments(texts: dict, encode_a, bytes_a, encode_b, bytes_b) -> dict:
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 by key; whole texts, every pair of tokens compared."""
    parts, held = {}, collections.Counter()
    for i, t in texts.items():
        a, b = (encode_a(" " + t), encode_b(t)) if t else ([], [])
        raw = f" {t}".encode()
        if b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
            a, b = [], []
        ends = [list(itertools.accumulate(len(spell(x)) for x in ids)) for ids, spell in ((a, bytes_a), (b, bytes_b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        group_of = [[bisect.bisect_left(cuts, e) for e in own] for own in ends]
        inside = [[[] for _ in cuts] for _ in ends]
        for own, of in zip(inside, group_of):
            for k, g in enumerate(of):
                own[g].append(k)
        groups, links = [], []
        for of_a, of_b in zip(*inside):
            groups.append("|".join(",".join(str(ids[k]) for k in own) for ids, own in ((a, of_a), (b, of_b))))
            for x in of_a:
                for y in of_b:
                    if max(ends[0][x] - len(bytes_a(a[x])), ends[1][y] - len(bytes_b(b[y]))) < min(ends[0][x], ends[1][y]):
                        links.append((a[x], b[y]))
        parts[i] = a, b, groups, links
        held.update(set(links))
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return {i: (len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for i, (a, b, groups, links) in parts.items()}
