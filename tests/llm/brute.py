"""Plain versions of the operators, for small inputs."""
from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text, k):
    w = words(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard_components(rows, k, percent):
    """rows: (doc_id, text). [(n, component_id, n_links)] by row."""
    sets = [grams(t, k) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    links[i] += 1
                    links[j] += 1
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return [(len(sets[i]), rows[i][0] if not sets[i] else least[find(i)], links[i]) for i in range(len(rows))], \
        [find(i) for i in range(len(rows))]


def substring_rows(rows, window=20):
    """rows: (doc_id, text). [(n_words, n_removed, kept text)] by row."""
    last = float("inf")
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            at = (last if d is None else d, i)
            first[key] = min(first.get(key, at), at)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (last if d is None else d, i):
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def leaks(rows, items, k=5, least=0.8):
    """{(row, item): best similarity} of item-sized windows."""
    def shingles(w):
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])

    out = {}
    for r, (_, t) in enumerate(rows):
        w = words(low(t))
        for i, (_, it) in enumerate(items):
            iw = words(low(it))
            if not iw or not w:
                continue
            c, best = Counter(shingles(iw)), 0.0
            for at in range(max(1, len(w) - len(iw) + 1)):
                x = Counter(shingles(w[at:at + len(iw)]))
                both = sum((x & c).values())
                best = max(best, both / (sum(x.values()) + sum(c.values()) - both))
            if best >= least:
                out[r, i] = best
    return out


def rule_counts(text):
    t = text or ""
    w = words(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def base_failed(text):
    n, _, _, _, repeated = rule_counts(text)
    return n < 50 or 100 * repeated > 50 * n


def secret_spans(text):
    t = text or ""
    out = [("assign", *m.span()) for m in re.finditer(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        t) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def luhn(s):
    d = [int(c) for c in s if c.isdigit() and c.isascii()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def pii_spans(text):
    t = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 13 <= len(re.findall("[0-9]", m.group())) <= 19 and luhn(m.group())]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return out


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
