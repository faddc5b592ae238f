"""Plain restatements of the contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def personal_data(rows):
    out = []
    for doc_id, text in rows:
        spans = base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        out.append((doc_id, *[sum(s[0] == k for s in spans) for k in KINDS], hashlib.sha256(joined.encode()).hexdigest()))
    return out


def all_spans(rows, support=3, generalise=0.8, common=0.1):
    """(doc_id, spans): base spans, then the disclosing words, by counting in whole rows."""
    entities, words, base = [], [], []
    for _, text in rows:
        text = text or ""
        spans = base_spans(text)
        values = {text[a:b].lower() for _, a, b in spans}
        values |= {"@" + v.split("@")[1] for v in list(values) if "@" in v}
        base.append(spans), entities.append(values), words.append({w.lower() for w in re.findall(r"[^\W\d_]{3,}", text)})
    n = len(rows)
    n_e = Counter(e for x in entities for e in x)
    n_t = Counter(w for x in words for w in x)
    n_te = Counter((e, w) for x, y in zip(entities, words, strict=True) for e in x for w in y)
    share = {(e, w): math.log2(n * c / (n_t[w] * n_e[e])) / math.log2(n / n_e[e]) for (e, w), c in n_te.items() if c >= support and support <= n_e[e] <= common * n}
    out = []
    for (doc_id, text), own, spans in zip(rows, entities, base, strict=True):
        terms = []
        for m in re.finditer(r"[^\W\d_]{3,}", text or ""):
            if any(share.get((e, m[0].lower()), 0) >= generalise for e in own) and not any(a < m.end() and m.start() < b for _, a, b in spans):
                terms.append(("term", m.start(), m.end()))
        out.append((doc_id, ",".join(f"{k}:{a}:{b}" for k, a, b in [*spans, *terms])))
    return out


def tokens(rows, encode, end_id):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*encode(text or ""), end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


def item_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, found = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if got := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingle_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def near_duplicates(rows):
    """All pairs that share a shingle, compared exactly."""
    sets = [shingle_set(t) for _, t in rows]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        both = defaultdict(int)
        for x in s:
            for j in at[x]:
                if j < i:
                    both[j] += 1
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), c, None if doc_id is None else doc_id == c))
    return out


def archives(rows):
    groups = defaultdict(list)
    for page, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            groups[body].append(page)
    out, stored = [], set()
    for page, html in rows:
        body = (html or "").encode()
        keep = max(groups[body]) if len(body) >= 1000 and groups.get(body) else None
        revisit = keep is not None and (page != keep or body in stored)
        if keep is not None and page == keep:
            stored.add(body)
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return out


def fill_in_middle(rows):
    """(doc_id, n, form, prefix_chars, middle_chars, output, text), by lists of units."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            out.append((doc_id, len(units), "plain", None, None, text, text))
        elif h[3] % 100 < 20:
            out.append((doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text))
        else:
            out.append((doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text))
    return out


def merkle(rows, arity=16):
    """rows: (doc_id, source, lang, n_chars, text); the contract's result for each."""
    h = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def tree(nodes):
        """The root, and for each node its (position, run) level by level."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            runs = [level[i : i + arity] for i in range(0, len(level), arity)]
            for k, i in enumerate(at):
                paths[k].append((i % arity, runs[i // arity]))
            at, level = [i // arity for i in at], [h(r) for r in runs]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        leaf = h(map(field, r))
        groups[r[1]].append((r[0], leaf, h(map(field, (*r[:4], lower(r[4])))) if tampered else leaf))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = tree([x[1] for x in groups[name]])
    root, upper = tree([trees[n][0] for n in names]) if names else (None, [])
    out = []
    for name, above in zip(names, upper, strict=True):
        for (doc_id, leaf, now), path in zip(groups[name], trees[name][1], strict=True):
            proof, seen = [], now
            for pos, run in path + above:
                proof += run[:pos] + run[pos + 1 :]
                seen = h([*run[:pos], seen, *run[pos + 1 :]])
            out.append((doc_id, leaf, trees[name][0], root, h(proof), seen, seen == root))
    return out


def repeats(rows, length=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), by all strings of the length."""
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
