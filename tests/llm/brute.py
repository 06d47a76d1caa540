"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def license_hits(text, rules):
    """All detections of the rules and which of them stand."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    plain = " " + " ".join(words) + " " if words else " "
    found = []
    for number, rule in enumerate(rules):
        if f" {rule.keyword} " in plain:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", plain):
                start = plain[: m.start()].count(" ") - 1
                found.append((start, start + m.group().count(" ") + 1, rule.priority, number))
    standing = [
        d
        for d in found
        if not any(
            o != d and o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and ((o[0], o[1]) != (d[0], d[1]) or o[2:] < d[2:]) for o in found
        )
    ]
    return sorted(found), sorted(standing)


def license_standing_ungated(text, rules):
    """Numbers of the rules whose detections stand, with every rule tried on every text."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    plain = f" {' '.join(words)} "
    found = []
    for number, rule in enumerate(rules):
        for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", plain):
            start = plain[: m.start()].count(" ")
            found.append((start, start + m.group().count(" ") + 1, rule.priority, number))

    def hidden(d):
        return any(o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and (o[:2] != d[:2] or o[2:] < d[2:]) for o in found if o != d)

    return [d[3] for d in found if not hidden(d)]


def tiktoken_encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def line_dedup(texts, min_docs=10):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    held = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    gone = {k for k, n in held.items() if n >= min_docs and k}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(5)]))


def components(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for i, s in sets.items():
        shared = Counter(j for x in s for j in index[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def edited(rows):
    """doc_id, length and edited text of (doc_id, text) rows, in falling order of ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[i] = (len(text), text[: len(text) - half] + following[:half])
    return out


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4
