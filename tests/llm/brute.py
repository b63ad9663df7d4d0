"""The operators' results by plain loops, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def benchmark_hits(docs, items, window=10):
    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    out = []
    for doc_id, text in docs:
        have, hit, found = cut(text), set(), set()
        for item_id, item in items:
            w = cut(item)
            size = min(len(w), window)
            for i in range(len(w) - size + 1) if size else ():
                for at in range(len(have) - size + 1):
                    if have[at : at + size] == w[i : i + size]:
                        hit |= set(range(at, at + size))
                        found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(have), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def near_duplicates(docs, k, percent=80):
    def shingles(text):
        w = words((text or "").translate(UPPER))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if docs[i][0] is not None and docs[j][0] is not None and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(sets[i]), least.get(find(i)), d is None or d == least[find(i)]) for i, (d, _) in enumerate(docs)]


def repeated_bytes(docs, window):
    first = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - window + 1) if doc_id is not None else ():
            s = b[i : i + window]
            first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - window + 1) if doc_id is not None else ():
            if first[b[i : i + window]] < doc_id:
                gone[i : i + window] = b"\1" * window
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((doc_id, len(b), len(b) - len(kept), spans, sha(kept)))
    return out


def repeated_words(docs, window):
    count = Counter()
    for _, text in docs:
        w = words(text)
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def quality(docs):
    out = []
    for doc_id, text in docs:
        w, t = words(text), text or ""
        rows = [x for x in t.split("\n") if words(x)]
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        n, chars, marks = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t))
        dup = len(rows) - len(set(rows))
        failed = n < 50 or 100 * len(repeat) > 50 * n
        lower = any(c.islower() or (c.isalpha() and not c.isupper()) for c in t)
        kept = not (failed or 10 * marks > 3 * n or 100 * dup > 50 * len(rows) or chars > 25 * n or not lower)
        out.append((doc_id, n, chars, marks, dup, len(repeat), failed, kept))
    return out


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def lines(docs, min_words):
    """For documents with different ids."""
    first = {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            if w := tuple(words(line)):
                first.setdefault(w, (doc_id is None, doc_id or 0, i))
    gone = {
        a for a in first for b in first
        if first[b] < first[a] and min(len(a), len(b)) >= min_words and within_one(a, b)
    }
    out = []
    for doc_id, text in docs:
        rows = (text or "").split("\n") if text is not None else []
        kept = [r for i, r in enumerate(rows) if not words(r) or (first[tuple(words(r))] == (doc_id is None, doc_id or 0, i) and tuple(words(r)) not in gone)]
        out.append((doc_id, sum(bool(words(r)) for r in rows), len(rows) - len(kept), sha("\n".join(kept))))
    return out


def groups(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return dict(out)


def byte_pairs(text, ranks, pattern):
    """Ids of a text: in every match of the pattern the pair of least rank is merged, leftmost first, until none is left."""
    import regex

    ids = []
    for match in regex.findall(pattern, text or ""):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], len(ranks)), i) for i in range(len(parts) - 1))
            if rank == len(ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        ids += [ranks[p] for p in parts]
    return ids


def alignment(docs, first, second, bytes_a, bytes_b):
    """``first`` and ``second`` encode a text; per document (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    groups = []
    for _, text in docs:
        a, b = (first(" " + text), second(text)) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            a, b = [], []
        own, ends = [], [[], []]
        for ids, table, out in ((a, bytes_a, ends[0]), (b, bytes_b, ends[1])):
            at = 0
            for i in ids:
                at += len(table[i])
                out.append(at)
        start = [0, 0]
        for end in sorted({*ends[0]} & {*ends[1]}):
            to = [ends[0].index(end) + 1, ends[1].index(end) + 1]
            own.append((a[start[0] : to[0]], b[start[1] : to[1]]))
            start = to
        groups.append(own)
    count = Counter()
    for own in groups:
        count.update({(x, y) for a, b in own for x in a for y in b})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), own in zip(docs, groups, strict=True):
        links = [(x, y) for a, b in own for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
        out.append((
            doc_id, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(links),
            sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha(text) if text else "",
        ))
    return out


def manifest(rows, arity=3):
    """Rows of (doc_id, source, ..., text): (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    import zlib

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            last = out[-1]
            out.append([sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            first = i // arity * arity
            yield "".join(level[first:i]), "".join(level[i + 1 : first + arity])
            i //= arity

    leaves = groups((r[1], (r[0] is not None, r[0] or 0, sha("".join(map(field, r))), r)) for r in rows)
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        leaves[s].sort(key=lambda x: x[:3])
        trees[s] = levels([x[2] for x in leaves[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(leaves[s]):
            steps = [*path(trees[s], i), *path(top, j)]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[-1] is not None
            own = sha("".join(map(field, (*r[:-1], r[-1].replace("\n", ""))))) if bad else leaf
            for before, after in steps:
                own = sha(before + own + after)
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, sha("".join(b + a for b, a in steps)), own, own == root))
    return out


def hilbert_walk(dims, bits):
    """The place of every cell along the curve, from each place's cell: bits dealt to the axes, Gray code undone, turns undone."""
    places = {}
    for place in range(1 << dims * bits):
        x = [0] * dims
        for i in range(dims * bits):
            x[i % dims] = x[i % dims] << 1 | place >> (dims * bits - 1 - i) & 1
        carry = x[-1] >> 1
        for i in range(dims - 1, 0, -1):
            x[i] ^= x[i - 1]
        x[0] ^= carry
        for level in range(1, bits):
            for i in range(dims - 1, -1, -1):
                low = (1 << level) - 1
                if x[i] >> level & 1:
                    x[0] ^= low
                else:
                    swap = (x[0] ^ x[i]) & low
                    x[0] ^= swap
                    x[i] ^= swap
        places[tuple(x)] = place
    return places


def shards(rows, n_shards, bits=4):
    """(doc_id, shard, slot) of rows (doc_id, text, source, lang), in the order of the curve."""
    axes = []
    for values in ([r[2] for r in rows], [r[3] for r in rows], [len((r[1] or "").encode()) + 8 for r in rows]):
        code = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}), 1)}
        ranks = sorted(code[v] for v in values if v is not None)
        cuts = [ranks[-(-i * len(ranks) // (1 << bits)) - 1] for i in range(1, 1 << bits)] if ranks else []
        axes.append([sum(code[v] > c for c in cuts) if v is not None else 0 for v in values])
    walk = hilbert_walk(len(axes), bits)
    at = [(walk[cell], zlib.crc32((r[1] or "").encode()), r[0]) for r, cell in zip(rows, zip(*axes, strict=True), strict=True)]
    out, sizes = [], Counter()
    for rank, (_, _, doc_id) in enumerate(sorted(at)):
        shard = rank * n_shards // len(rows)
        out.append((doc_id, shard, sizes[shard]))
        sizes[shard] += 1
    return out


def languages(learned, texts, ridge=1e-2, bits=13):
    """(language, score) of each text by kernel ridge regression on all ``learned`` (text, lang), as many of each language."""

    def grams(text):
        data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
        found = set()
        for n in (2, 3, 4):
            for i in range(len(data) - n + 1):
                found.add((n, (int.from_bytes(data[i : i + n], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - bits))
        return found

    def likeness(a, b):
        return len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5

    known, names = [grams(t) for t, _ in learned], sorted({lang for _, lang in learned})
    gram = np.array([[likeness(a, b) for b in known] for a in known])
    target = np.array([[1.0 if lang == name else -1.0 for name in names] for _, lang in learned])
    middle = np.eye(len(known)) - 1 / len(known)
    dual = np.linalg.solve(middle @ gram @ middle + ridge * np.eye(len(known)), middle @ target)
    out = []
    for text in texts:
        own = grams(text)
        row = middle @ (np.array([likeness(own, b) for b in known]) - gram.mean(1))
        scores = row @ dual + target.mean(0)
        out.append((names[int(scores.argmax())], min(max((scores.max() + 1) / 2, 0), 1)))
    return out
