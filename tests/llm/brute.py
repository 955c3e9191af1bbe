"""Plain versions of the dealt operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def substring_dedup(docs, width=13):
    """(doc_id, n_words, n_removed, sha256) of each (doc_id, text), as a Counter."""
    least = {}
    for i, text in docs:
        w = words(text)
        for j in range(len(w) - width + 1 if i is not None else 0):
            key = tuple(w[j:j + width])
            least[key] = min(i, least.get(key, i))
    out = Counter()
    for i, text in docs:
        w, gone = words(text), set()
        for j in range(len(w) - width + 1 if i is not None else 0):
            if least[tuple(w[j:j + width])] < i:
                gone.update(range(j, j + width))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingle_set(text, width=5):
    w = words(lowered(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[j:j + width]) for j in range(len(w) - width + 1)}


def jaccard(docs):
    """(doc_id, n_shingles, component_id) of each (doc_id, text), as a Counter."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    links = []
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is None or j is None or not a or not b:
                continue
            if 100 * len(a & b) >= 75 * len(a | b):
                links.append((i, j))
    part = components({i for i, _ in docs if i is not None}, links)
    return Counter((i, len(s), part.get(i)) for i, s in sets)


def good(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def near_vectors(rows, cosine=0.93):
    """{(vec_id, n_links, component)} of (vec_id, vector, label) with distinct ids."""
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, label in rows
            if i is not None and label is not None and good(v)}
    label = {i: lab for i, _, lab in rows}
    links = [(i, j) for i in unit for j in unit
             if i < j and label[i] == label[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    part = components([i for i, _, _ in rows if i is not None], links)
    n = Counter(x for link in links for x in link)
    return sorted((i, n[i], part.get(i)) for i, _, _ in rows if i is not None)


def nearest(rows, k=10, every=100):
    out = []
    vectors = [(i, np.array(v, float)) for i, v in rows if i is not None and good(v)]
    for q, v in vectors:
        if q % every:
            continue
        near = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in vectors if i != q and len(x) == len(v))
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])]
    return out


def ids_crc32(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha_ids(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
