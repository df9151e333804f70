"""Plain single-process versions of the operators, for small tables."""

import base64
import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict
from decimal import Decimal

BLANK = re.compile(r"[\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def decontaminate(docs, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    grams = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(low(text))
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            if w:
                grams[tuple(w[i:i + k])].add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = {}
    for doc, text in docs:
        w = ITEM_WORD.findall(low(text))
        hit, met = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i:i + k])) in grams:
                    hit.update(range(i, i + k))
                    met |= grams[g]
        out[doc] = (len(w), len(hit), len(met), sha(",".join(sorted(met))), bool(hit))
    return out


def shingle_set(text, width=5):
    w = WORD.findall(low(text))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def near(docs, percent=75):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs."""
    ids = [d for d, _ in docs]
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, d in enumerate(ids)}


def repeats(docs, length=400):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    data = {d: (t or "").encode() for d, t in docs}
    seen = Counter(b[i:i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def lines(docs, min_docs=10):
    keys = [[low(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")] for _, t in docs]
    found = Counter(k for own in keys for k in set(own) if k)
    out = {}
    for (d, t), own in zip(docs, keys, strict=True):
        kept = [x for x, k in zip((t or "").split("\n"), own, strict=True) if found[k] < min_docs]
        out[d] = (len(own), len(own) - len(kept), sha("\n".join(kept)))
    return out


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), d is None, d))
    out = {}
    for text, rows in groups.items():
        keep = min(rows, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        for _, _, d in rows:
            out[d] = (keep, len(rows), d == keep, sha(text))
    return out


def warc(pages, min_bytes=0):
    best = {}
    data = {p: (h or "").encode() for p, h in pages}
    for p, b in data.items():
        best[b] = max(p, best.get(b, p))
    return {p: (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                "revisit" if len(b) >= min_bytes and best[b] != p else "response",
                best[b] if len(b) >= min_bytes and best[b] != p else None) for p, b in data.items()}


def chat(turns, loss_role="assistant"):
    """turns: (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = defaultdict(list)
    for c, t, r, x in turns:
        by[c].append((t, r or "", x or ""))
    out = {}
    for c, own in by.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == loss_role)
        out[c] = (len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss))
    return out


def repeat_words(words):
    """Words inside 3-word windows found twice or more."""
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if found[g] > 1 for k in range(3)})


def quality_counts(text):
    """{name: count} of a text"""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat_words(w), "n_upper": len(re.findall("[A-Z]", t)),
            "n_marks": len(re.findall("[!?]", t))}


def binomial_tail(k, n, rate):
    p = Decimal(rate)
    return float(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))


def quality_rules(docs, labels, rules, risk, miss):
    """docs: (id, stratum, text) -> [(id, counts, base_failed, kept)] in order"""
    rows = []
    for d, s, t in docs:
        c = quality_counts(t)
        rows.append((d, s, c, c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]))
    marks = defaultdict(set)
    for d, q in labels:
        if d is not None and q is not None:
            marks[d].add(q)
    good = [(s, c) for d, s, c, failed in rows if not failed and marks.get(d) == {1}]
    strata = {s for s, _ in good}

    def rejects(rule, cutoff, c):
        a, b = 100 * c[rule.part], cutoff * c[rule.whole]
        return a > b if rule.above else a < b

    cut = {}
    for s in strata:
        own = [c for x, c in good if x == s]
        for rule in rules:
            for cutoff in rule.grid:
                k = sum(rejects(rule, cutoff, c) for c in own)
                if binomial_tail(k, len(own), risk / len(rules)) > miss / (len(strata) * len(rules)):
                    break
                cut[s, rule.name] = cutoff
    return [(d, c, failed, not failed and not any((s, r.name) in cut and rejects(r, cut[s, r.name], c) for r in rules)) for d, s, c, failed in rows]


SEARCH_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lexical(docs, queries, k=10):
    """{(query, rank): (id, score)} by scoring every document for every query."""
    rows = [(d, Counter(SEARCH_TERM.findall(low(t)))) for d, t in docs]
    rows = [(d, c) for d, c in rows if c]
    total = sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = defaultdict(Counter)
    for q, t in queries:
        asked[q].update(SEARCH_TERM.findall(low(t)))
    out = {}
    for q, terms in asked.items():
        scored = []
        for d, c in rows:
            m = 25 + 75 * sum(c.values()) * len(rows) // total
            s = sum(n * math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in terms.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        for i, x in enumerate(sorted(scored, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]):
            out[q, i + 1] = (x[2], -x[0])
    return out


def audit(docs, labels):
    """docs: (id, part, text); labels: (id, quality, toxic) -> {(part, order, step): counts} by applying every order."""
    least = {}
    for d, _, t in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({d for d, *x in labels if x[i] == 1 and d is not None} for i in (0, 1))
    rows = defaultdict(list)
    for d, p, t in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and least[t] < d}
        rows[p or ""].append((d, {x for x, y in fails.items() if y}))
    out, sums = {}, Counter()
    for part, own in rows.items():
        for order in itertools.permutations("ABCDE"):
            kept = own
            for i, x in enumerate(order):
                gone = [r for r in kept if x in r[1]]
                kept = [r for r in kept if x not in r[1]]
                failing = sum(x in r[1] for r in own)
                sums[part, x] += len(gone)
                out[part, "".join(order), i + 1] = [len(kept), len(gone), failing - len(gone), sum(r[1] == {x} for r in own),
                                                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), x]
    return {key: (*v[:-1], sums[key[0], v[-1]]) for key, v in out.items()}
