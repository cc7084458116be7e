"""The contracts of the queries, done plainly in one process."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

from fraudloom.llm.bpe import read_ranks

BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def byte_bpe(docs):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def near_vectors(rows, least=0.95):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    groups, links = Groups(), Counter()
    good = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    for i, _ in rows:
        groups.root(i)
    for a, (i, v) in enumerate(good):
        for j, w in good[a + 1:]:
            if len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= least:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    return [(i, links[i], groups.root(i), groups.root(i) == i) for i, _ in rows]


def license_base(docs):
    out = []
    for doc_id, text in docs:
        words = LICENSE_WORD.findall(lower(text or ""))
        places, labels = [], set()
        for phrase, label in PHRASES.items():
            want = phrase.split()
            for at in range(len(words)):
                if words[at:at + len(want)] == want:
                    places.append(at)
                    labels.add(label)
        out.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return out


def dedup_lines(docs):
    def key(line):
        return lower(line.strip(BLANK))

    first = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < 10 or first[key(line)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def token_files(docs, end_id=1):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def token_counts(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in docs]


def quality_measures(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered.update((i, i + 1, i + 2))
        out.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
                    len(words) < 50 or 100 * len(covered) > 50 * len(words)))
    return out


def simhash(docs, width=3, budget=3):
    prints = {}
    for doc_id, text in docs:
        words = WORD.findall(lower(text or ""))
        shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    groups, ids = Groups(), list(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    for i, value in zip(ids, values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= budget):
            groups.join(i, ids[j])
    return [(i, f"{prints[i]:016x}", groups.root(i)) for i in ids]


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Shares by source from a dict of sizes: shared again and again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        open_ = [s for s in order if s not in fixed]
        rest = share * sum(sizes.values()) - sum(fixed.values())
        total = sum(weight[s] for s in open_)
        part = {s: rest * weight[s] / total for s in open_}
        above = [s for s in open_ if part[s] > limit * sizes[s]]
        if not above:
            return {**fixed, **part}
        fixed.update({s: limit * sizes[s] for s in above})


def library_bpe(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest()))
    return out


def _whole(v, scale):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and [math.floor(scale * x) for x in v]


def hard_negatives(rows, step=100, positives=5, negatives=10):
    """Rows (vec_id, label, vector) with their labels as they are."""
    good = [(i, label, _whole(v, 256)) for i, label, v in rows if i is not None and label is not None and _whole(v, 256) is not False]
    out = []
    for a, (anchor, label, q) in enumerate(good):
        if anchor % step:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, of == label)
                  for b, (i, of, v) in enumerate(good) if b != a and len(v) == len(q)]
        for top, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted(s for s in scored if not s[2] and 30 * -top <= 100 * -s[0] <= 90 * -top)
            out += [(anchor, positive, rank, i, -top, -s) for rank, (s, i, _) in enumerate(fit[:negatives], 1)]
    return out


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """Rows (vec_id, label, vector) of one vector length."""
    kept = [(i, label, _whole(v, 4096)) for i, label, v in rows if _whole(v, 4096) is not False]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0))
    dim = len(kept[0][2])
    cut = [[r[2][dim * p // parts:dim * (p + 1) // parts] for p in range(parts)] for r in kept]
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), n) for n, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for r in cut:
                held[assign(r[p], books[p])[1]].append(r[p])
            books[p] = [[sum(xs) // len(ps) for xs in zip(*ps)] if ps else old for ps, old in zip(held, books[p])]
    found = [[assign(r[p], books[p]) for p in range(parts)] for r in cut]
    errors = [sum(e for e, _ in f) for f in found]
    by_label = Counter()
    for (_, label, _), error in zip(kept, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(i, "".join(f"{n:02x}" for _, n in f), error, by_label[label], digest)
            for (i, label, _), f, error in zip(kept, found, errors)]
