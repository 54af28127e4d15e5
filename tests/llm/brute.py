"""Plain single-process versions that the operators' results are compared with."""

from __future__ import annotations

import hashlib
import re

sha = lambda b: hashlib.sha256(b).hexdigest()
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m)
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only(m)) <= 19 and luhn(only(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only(m)) <= 15))
    spans = [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]
    return [sum(s[0] == k for s in spans) for k, _, _ in rules], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode())


def secrets(text):
    text = text or ""
    rules = (("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32))
    spans = sorted((m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m))
    return [sum(s[3] == k for s in spans) for k, _, _ in rules], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode())


def shingles(text) -> set:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = SPACE.findall(low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(docs):
    """doc_id -> (n_shingles, component_id); rows with one id are one node."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, (d, s) in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((root(d), root(sets[j][0])))
                parent[b] = a
    return sorted((d, len(s), root(d)) for d, s in sets)


def repeats(docs, size=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256); docs in order of id."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            w = b[i:i + size]
            if w in seen:
                gone[i:i + size] = b"\1" * size
            else:
                seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def spelling(docs):
    """(word, form, root, n, n_near, form_n) of all words; near words by deleting a letter at every place."""
    import zlib

    n: dict = {}
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    holes: dict = {}
    near: dict = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
            if (shorter := w[:i] + w[i + 1:]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for ws in holes.values():
        for w in ws:
            near[w] |= ws - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def lexical(docs, items, k=10):
    """(item_id, rank, doc_id, score); docs and items as (id, text)."""
    import math

    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    terms = lambda t: [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in term.findall(t or "")]
    bags = [(d, terms(t)) for d, t in docs]
    total, count = sum(len(b) for _, b in bags), sum(1 for _, b in bags if b)
    df: dict = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    wanted: dict = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, query in wanted.items():
        scores = []
        for d, b in bags:
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * b.count(t)) // (1000 * b.count(t) + 8 * (10 + 90 * len(b) * count // total)))
                    for t in query & set(b))
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def packed(docs, library, pieces, end=1, window=2048):
    """Check ``pieces`` (rows of the packing) against the ids that the library gives; None if all is well."""
    import struct
    import zlib
    from collections import Counter

    want = Counter()
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [end]
        want[d, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    at: dict = {}
    for p in pieces:
        at.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for seq, parts in at.items():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0, (seq, offset, place)
            place += length
        assert place == window or seq == max(at), (seq, place)
    assert sorted(at) == list(range(len(at)))
    return want


class Language:
    """Words first, then n-grams, from (language, text) rows; one word at a time."""

    def __init__(self, rows, orders=(4, 3, 2, 1)):
        from collections import Counter, defaultdict

        self.orders, self.langs = orders, sorted({lang for lang, _ in rows})
        self.words, self.grams = defaultdict(Counter), defaultdict(Counter)
        for lang, text in rows:
            for w in self.split(text):
                self.words[w][lang] += 1
                for order in orders:
                    for g in self.cut(w, order):
                        self.grams[g][lang] += 1
        self.totals = {(None, x): sum(c[x] for c in self.words.values()) + 0.1 * len(self.words) for x in self.langs}
        for order in orders:
            same = [c for g, c in self.grams.items() if len(g) == order]
            self.totals |= {(order, x): sum(c[x] for c in same) + 0.1 * len(same) for x in self.langs}

    @staticmethod
    def split(text):
        import unicodedata

        return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()

    @staticmethod
    def cut(w, order):
        p = f"^{w}$"
        return [p[i:i + order] for i in range(len(p) - order + 1)]

    def predict(self, text):
        import math

        words = self.split(text)
        if not words:
            return "und", 0.0
        total = dict.fromkeys(self.langs, 0.0)
        for w in words:
            known, order = ([self.words[w]], None) if w in self.words else ([], None)
            for o in self.orders:
                if not known:
                    known, order = [self.grams[g] for g in self.cut(w, o) if g in self.grams], o
            for x in self.langs:
                if known:
                    total[x] += sum(math.log(c[x] + 0.1) - math.log(self.totals[order, x]) for c in known) / len(known)
        best = min(self.langs, key=lambda x: (-total[x], x))
        scale = min(len(words), 12) / len(words)
        return best, 1 / sum(math.exp((total[x] - total[best]) * scale) for x in self.langs)
