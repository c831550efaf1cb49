"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import os
import re
from html.parser import HTMLParser

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near(docs):
    """doc_id to (n_shingles, component_id, kept); ids are distinct."""
    sets = {}
    for doc_id, text in docs:
        w = words(lower(text))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def repeats(docs, size=13):
    """doc_id to (n_words, n_removed, kept_sha256)."""
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < doc_id:
                gone.update(range(i, i + size))
        out[doc_id] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def targets(sizes, share=1.5, epochs=2.0, weights=(3.0, 1.0, 2.0)):
    """Reshare the excess by weight, again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            got[s] += give[s]
            if got[s] >= epochs * sizes[s]:
                left += got[s] - epochs * sizes[s]
                got[s] = epochs * sizes[s]
                open_.discard(s)
    return got


def winnow(text, gram, window, value):
    """Positions kept from the gram values: the rightmost least value of each window."""
    grams = [value(text[i : i + gram]) for i in range(max(1, len(text) - gram + 1))] if text else []
    kept = set()
    for i in range(max(1, len(grams) - window + 1)) if grams else []:
        part = grams[i : i + window]
        least = min(part)
        kept.add(i + max(j for j, v in enumerate(part) if v == least))
    return sorted(kept)


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


BASE_KINDS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 0, 18),
    "hex": ("[0-9a-f]+", 0, 0, 16),
}


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256."""
    found = []
    for place, (kind, (pattern, flags, group, least)) in enumerate(BASE_KINDS.items()):
        for m in re.finditer(pattern, text or "", flags):
            if len(m[group]) >= least:
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    counts = [sum(place == k for _, place, _ in found) for k in range(3)]
    return (*counts, sha(",".join(span for _, _, span in sorted(found))))


def divergence(docs, min_docs=3, ranks=200):
    """Rows (lang, source, part, item, value, rank) from rows of (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        having = {}
        for _, _, terms in own:
            for t in set(terms):
                having[t] = having.get(t, 0) + 1
        kept = sorted(t for t, n in having.items() if n >= min_docs)
        counts = {s: {} for s in {d[1] for d in own}}
        for _, s, terms in own:
            for t in terms:
                counts[s][t] = counts[s].get(t, 0) + 1
        whole = {t: sum(c.get(t, 0) for c in counts.values()) for t in kept}

        def p_of(count):
            total = sum(count.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (count.get(t, 0) + 1) // (total + len(kept)) for t in kept}

        p, q = {s: p_of(c) for s, c in counts.items()}, p_of(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            parts = {
                "pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s],
                "term": [(f(p[s][t], q[t]), t) for t in kept if counts[s].get(t, 0) and p[s][t] > q[t]],
            }
            for part, rows in parts.items():
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                rows = rows if part == "pair" else rows[:ranks]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(rows)]
    return sorted(out)


def hard_negatives(rows, positives=5, negatives=3):
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, vector, label)."""
    own = []
    for vec_id, vector, label in rows:
        if None not in (vec_id, vector, label) and all(x is not None and math.isfinite(x) for x in vector):
            own.append((vec_id, [math.floor(256 * x) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for a, v, label in own:
        if a % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), b, other) for b, w, other in own if b != a))
        for s, b, _ in [r for r in scored if r[2] == label][:positives]:
            near = [(n, -t) for t, n, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, b, i + 1, n, -s, t) for i, (n, t) in enumerate(near[:negatives])]
    return sorted(out)


class _Lines(HTMLParser):
    """Lines of a well-formed page with their kinds (1 article, 0 open, -1 noise), by the standard library's parser."""

    BLOCKS = {"p", "div", "article", "main", "nav", "footer", "header", "section", "ul", "li", "h1", "h2", "form", "aside", "table", "tr", "td", "body", "html"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.stack, self.hidden = [], [], [0], 0

    def flush(self):
        line = re.sub(r"\s+", " ", "".join(self.text)).strip()
        self.text = []
        if line:
            self.lines.append((line, self.stack[-1]))

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.hidden += 1
        elif tag == "br":
            self.text.append(" ")
        elif tag in self.BLOCKS:
            self.flush()
            kind, names = self.stack[-1], set((dict(attrs).get("class") or "").split())
            if kind >= 0:
                if tag in ("nav", "footer", "form", "aside") or names & {"ad", "comments", "comment-list", "ad-slot"} or tag == "header" and kind < 1:
                    kind = -1
                elif tag in ("article", "main"):
                    kind = 1
            self.stack.append(kind)

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.hidden -= 1
        elif tag in self.BLOCKS:
            self.flush()
            self.stack.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def _common(a, b):
    """Positions in `a` of one longest common subsequence, by the full table; equal ends first."""
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            n[i][j] = n[i + 1][j + 1] + 1 if a[i] == b[j] else max(n[i + 1][j], n[i][j + 1])
    out, i, j = set(), 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.add(i)
            i, j = i + 1, j + 1
        elif n[i + 1][j] >= n[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def main_texts(pages):
    """page_id to text, from rows of (page_id, url, html) with distinct pages and lines that repeat on no page."""
    rows = []
    for page_id, url, page in pages:
        host, path = re.match(r"https?://([^/]*)(.*)", url).groups()
        parser = _Lines()
        parser.feed(page or "")
        parser.close()
        parser.flush()
        rows.append((host.lower(), path, page_id, parser.lines))
    rows.sort(key=lambda r: r[:3])
    out = {}
    for k, (host, path, page_id, lines) in enumerate(rows):
        near = []
        for place, o in enumerate((k - 1, k + 1)):
            if 0 <= o < len(rows) and rows[o][0] == host:
                near.append((-len(os.path.commonprefix([path, rows[o][1]])), place, rows[o][3]))
        gone, copy = set(), False
        for _, _, other in sorted(near, key=lambda x: x[:2]):
            both = _common([t for t, _ in lines], [t for t, _ in other])
            mine, yours = sum(len(t) for t, kind in lines if kind == 0), sum(len(t) for t, kind in other if kind >= 0)
            same = sum(len(lines[i][0]) for i in both if lines[i][1] == 0)
            copy = 10 * same >= 9 * min(mine, yours) and 2 * same >= max(mine, yours) > 0
            if not copy:
                gone = both
                break
        out[page_id] = "\n".join(t for i, (t, kind) in enumerate(lines) if kind == 1 or kind == 0 and i not in gone)
    return out


def ftrl(rows, labels, alpha, beta, l1, l2, epochs, positive):
    """FTRL-proximal one coordinate after the other: the bias and a dictionary of the weights that are not zero."""
    z, n = {}, {}

    def weight(i):
        at = z.get(i, 0.0)
        if i != "bias" and abs(at) <= l1:
            return 0.0
        return -(at - math.copysign(l1, at) * (at != 0)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for own, label in zip(rows, labels):
            w = {i: weight(i) for i in [*own, "bias"]}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values())))))
            g = (p - label) * (positive if label else 1.0)
            for i in w:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return weight("bias"), {i: weight(i) for i in z if i != "bias" and weight(i)}
