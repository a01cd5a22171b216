"""Personal data: patterns, and a character tagger that adds what they miss.

The tagger (``char_tagger``) learns email, IP, card and phone spans from
labelled windows: spans the patterns find in a bounded sample of documents
(TRAIN_DOCS, chosen by a hash of the text), each also rewritten in formats the
patterns do not know (national phone numbers, other separators, bracketed
``at``), and as many windows without one. Only tiles that can start a span
passing its kind's check are decoded. A number's span starts in the tile of its
first digit or the one before; an email holds an ``@`` or a bracketed ``at``
and no line feed, so all tiles from the line's start up to one of these are
decoded, but for the ``@`` of an email that the patterns found. Decoded spans
are reconciled over the whole text: each belongs to the tile it starts in, one
that its window's end cuts goes on in later windows, and each must pass its
kind's check (digits, checksum, parts) and must not overlap a pattern's span or
an earlier decoded one.

Null and empty texts have no spans; repeated rows each have their own row; a
null id stays null. An empty table still fits a model, from the built-in
formats in neutral context.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.char_tagger import PAD, TILE, WINDOW, Tagger, char_ids, windows, windows_from
from fleetyard.llm.frames import column, give_back, map_batches, texts

KINDS = ("email", "ip", "card", "phone")
# Documents that training windows are taken from, at most.
TRAIN_DOCS = 400
TRAIN_WINDOWS = 1200

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, which keeps this linear.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for n, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if n % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def _byte_value(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 13 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> list[tuple[int, int]]:
    out, bound, at = [], 0, text.find("@")
    while at >= 0:
        local = text[bound:at]
        n = len(local) - len(local.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if n else None
        if m:
            out.append((at - n, m.end()))
        bound = m.end() if m else at + 1
        at = text.find("@", bound)
    return out


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by kind as listed, then start; leftmost, non-overlapping within a kind."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte_value, m.groups()))]
        out += [("card", *m.span()) for m in _CARD.finditer(text)
                if m.end() - m.start() >= 13 and _card_ok(m.group())]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_AT = re.compile(r"@|[\[(]\s?at\s?[\])]", re.IGNORECASE)


def plausible(kind: str, s: str) -> bool:
    """The check of a decoded span's own characters."""
    if kind == "email":
        return bool(_AT.search(s)) and "." in s and not re.search(r"\n", s)
    if kind == "ip":
        parts = re.split(r"[^0-9]+", s.strip("[]()"))
        return len(parts) == 4 and all(p and _byte_value(p) for p in parts)
    if kind == "card":
        return _card_ok(s) and not re.search(r"[A-Za-z\n]", s)
    return 9 <= len(_digits(s)) <= 15 and not re.search(r"[A-Za-z\n@]", s)


# --- training --------------------------------------------------------------

_CONTEXT = "the value of this and that was in one of the notes for them to read. It is here with more"


def _variants(kind: str, s: str, r: np.random.Generator) -> list[str]:
    """The same datum in formats outside the patterns."""
    if kind == "email":
        forms = []
        for at in ("[at]", "(at)"):
            name, _, domain = s.partition("@")
            if r.random() < 0.5:        # not every address has digits
                name, domain = _DIGIT.sub("", name).strip("._%+-") or "info", _DIGIT.sub("", domain)
            forms.append(name + at + domain)
        return forms
    d = _digits(s)
    if kind == "phone":
        d = (d + "".join(map(str, r.integers(0, 10, 11))))[:11]
        return [f"({d[1:4]}) {d[4:7]}-{d[7:]}", f"00{d[0]} {d[1:4]} {d[4:7]} {d[7:]}", f"+{d[0]}/{d[1:4]}/{d[4:]}"]
    if kind == "card":
        q = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [".".join(q), "/".join(q), " ".join(q), "-".join(q)]
    return [s.replace(".", "-"), s.replace(".", " . ")] if r.random() < 0.3 else []


def _generated(r: np.random.Generator) -> list[tuple[str, str]]:
    """Built-in examples of the formats, for corpora that have few."""
    n = lambda a, b: str(r.integers(a, b))
    out = []
    for _ in range(12):
        out.append(("email", f"{'abcdefgh'[r.integers(0, 8)]}na.{n(1, 99)}@mail{n(0, 9)}.example.com"))
        out.append(("ip", ".".join(n(0, 256) for _ in range(4))))
        out.append(("phone", f"+{n(1, 99)} ({n(100, 999)}) {n(100, 999)}-{n(1000, 9999)}"))
        d = "4" + "".join(n(0, 10) for _ in range(14))
        out.append(("card", d + next(x for x in "0123456789" if luhn(d + x))))
    return out


def _window_of(before: str, s: str, after: str, kind: str | None, shift: int,
               edges: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One training window: s starts ``shift`` into the middle tile. ``edges``:
    characters that the text has before and after s, as near a text's ends."""
    if edges:
        before, after = before[len(before) - min(edges[0], len(before)):], after[:edges[1]]
    text = before[-(TILE + shift):] + s + after
    lead = TILE + shift - len(before[-(TILE + shift):])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ids = np.full(WINDOW, PAD, dtype=np.int64)
    n = min(len(points), WINDOW - lead)
    ids[lead:lead + n] = char_ids(points[:n])
    tags = np.zeros(WINDOW, dtype=np.int64)
    if kind:
        k = KINDS.index(kind)
        a, b = TILE + shift, min(WINDOW, TILE + shift + len(s))
        tags[a:b] = 2 * k + 2
        tags[a] = 2 * k + 1
    return ids, tags


def training_windows(sample: list[str], limit: int = TRAIN_WINDOWS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    rows: list[tuple[np.ndarray, np.ndarray]] = []

    def add(before, s, after, kind):
        edges = (int(r.integers(0, 24)), int(r.integers(0, 24))) if r.random() < 0.2 else None
        rows.append(_window_of(before, s, after, kind, int(r.integers(0, TILE)), edges))

    for kind, s in _generated(r):
        for form in [s, *_variants(kind, s, r)]:
            add(_CONTEXT + " ", form, " " + _CONTEXT, kind)
    numbers = re.compile(r"[0-9][0-9.,:/-]*")
    for text in sample:
        if len(rows) >= limit:
            break
        spans = pattern_spans(text)
        for kind, a, b in spans[:8]:
            near = any(x < b + WINDOW and a - WINDOW < y and (x, y) != (a, b) for _, x, y in spans)
            before, after = (_CONTEXT + " ", " " + _CONTEXT) if near else (text[max(0, a - WINDOW):a], text[b:b + WINDOW])
            for form in [text[a:b], *_variants(kind, text[a:b], r)]:
                add(before, form, after, kind)
        for _ in range(2):
            at = int(r.integers(0, max(1, len(text))))
            if not any(x < at + WINDOW and at - WINDOW < y for _, x, y in spans):
                add(text[max(0, at - WINDOW):at], "", text[at:at + WINDOW], None)
                # other numbers are not personal data
                n = "".join(map(str, r.integers(0, 10, int(r.integers(1, 9)))))
                n = [n, f"20{n[:2]}-0{n[:1]}-1{n[:1]}", f"{n}.{n[:2]}", f"{n[:1]}.{n[:2]}.{n[:1]}", f"{n}%"][int(r.integers(0, 5))]
                add(text[max(0, at - WINDOW):at] + " ", n, " " + text[at:at + WINDOW], None)
        for m in list(numbers.finditer(text))[:4]:
            if not any(x < m.end() + TILE and m.start() - TILE < y for _, x, y in spans) and len(m.group()) < 9:
                add(text[max(0, m.start() - WINDOW):m.start()], m.group(), text[m.end():m.end() + WINDOW], None)
    ids, tags = zip(*rows[:limit])
    return np.array(ids), np.array(tags)


def fit_tagger(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> Tagger:
    """Fit on at most ``max_docs`` documents, those with the smallest text hashes
    among the ones holding a digit; training is deterministic."""
    t = docs.select(docs["text"].alias("text")).filter(F.col("text").rlike("[0-9]")).withColumn("h", F.xxhash64("text"))
    # first the hashes alone, then the texts of those: copies count once, and
    # what comes to the driver does not grow with the input's partitions
    last = t.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    rows = [] if last is None else (t.filter(F.col("h") <= last).groupBy("h").agg(F.first("text").alias("text"))
                                    .orderBy("h").collect())
    tagger = Tagger.new(2 * len(KINDS) + 1)
    tagger.fit(*training_windows([r["text"] for r in rows]))
    return tagger


# --- scanning --------------------------------------------------------------

def _run_end(tags: np.ndarray, k: int, end: int) -> int:
    """Where the inside tags of kind k that go on at ``end`` stop."""
    while end < WINDOW and tags[end] == 2 * k + 2:
        end += 1
    return end


def _decoded(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans in a window's tags that start in its middle
    tile; one with end WINDOW may go on."""
    out, t = [], TILE
    while t < 2 * TILE:
        tag = int(tags[t])
        if tag % 2 == 1:
            k = tag // 2
            end = _run_end(tags, k, t + 1)
            out.append((k, t, end))
            t = end
        else:
            t += 1
    return out


def _tiles(text: str, base: list[tuple[str, int, int]]) -> np.ndarray:
    """The tiles where a span that ``plausible`` accepts can start, clear of the patterns' spans ``base``."""
    at = np.fromiter((m.start() for m in _DIGIT.finditer(text)), dtype=np.int64) // TILE
    tiles = [at, np.maximum(0, at - 1)]
    if "@" in text or "[" in text or "(" in text:
        emails = {text.index("@", a): b for kind, a, b in base if kind == "email"}
        line = 0
        for m in _AT.finditer(text):
            if m.start() in emails:
                line = emails[m.start()]
            else:
                line = max(line, text.rfind("\n", line, m.start()) + 1)
                tiles.append(np.arange(line // TILE, m.start() // TILE + 1))
                line = m.start()
    return np.unique(np.concatenate(tiles))


def _tags_of(ids: list[np.ndarray], tagger: Tagger) -> tuple[np.ndarray, list[int]]:
    """Tags of the distinct windows, and each window's row in them: copies are decoded once."""
    keys, inverse = np.unique(np.concatenate(ids), axis=0, return_inverse=True)
    tags = np.concatenate([tagger.decode(keys[a:a + 1024]) for a in range(0, len(keys), 1024)])
    return tags, inverse.reshape(-1).tolist()


def scan_batch(batch: list[str], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """All spans of each text, by kind as listed, then start."""
    out = [pattern_spans(t) for t in batch]
    points = lambda n: np.frombuffer(batch[n].encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ids, where = [], []
    for n, text in enumerate(batch):
        tiles = _tiles(text, out[n])
        if len(tiles):
            ids.append(windows(points(n), tiles))
            where += [(n, int(t)) for t in tiles]
    spans, cut = [], []
    if ids:
        tags, rows = _tags_of(ids, tagger)
        found = [_decoded(row) if row.any() else [] for row in tags]
        for (n, tile), row in zip(where, rows):
            first = (tile - 1) * TILE
            for k, a, b in found[row]:
                if b < WINDOW or first + b >= len(batch[n]):
                    spans.append((n, first + a, first + b, k))
                else:       # seen again with its start where the middle tile starts
                    cut.append((n, first + a, first + b, k, first + a - TILE))
    while cut:
        tags, rows = _tags_of([windows_from(points(n), np.array([first])) for n, _, _, _, first in cut], tagger)
        more = []
        for (n, a, b, k, first), row in zip(cut, rows):
            end = first + _run_end(tags[row], k, b - first)
            if end < first + WINDOW or end >= len(batch[n]):
                spans.append((n, a, end, k))
            else:
                more.append((n, a, end, k, first + TILE))
        cut = more
    for n, a, b, k in sorted(spans):
        text = batch[n]
        b = min(b, len(text))
        if a < b and plausible(KINDS[k], text[a:b]) and not any(x < b and a < y for _, x, y in out[n]):
            out[n].append((KINDS[k], a, b))
    return [sorted(s, key=lambda x: (KINDS.index(x[0]), x[1])) for s in out]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
          "base_sha256 string, spans string")


def pii_spans(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: pattern counts and digest, and all spans."""
    tagger = fit_tagger(docs, max_docs)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch_texts = [(t or b"").decode("utf-8", "replace") for t in column(batch, "text").to_pylist()]
        rows = []
        for text, spans in zip(batch_texts, scan_batch(batch_texts, tagger)):
            base = pattern_spans(text)
            n = Counter(k for k, _, _ in base)
            rows.append((*(n[k] for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        cols = list(zip(*rows)) if rows else [[]] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id")] + [pa.array(c, t) for c, t in zip(cols, types)],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return map_batches(texts(docs), run, SCHEMA)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the union is replaced."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked_text(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> Column:
    """The text of ``docs`` without personal data; null stays null."""
    tagger = fit_tagger(docs, max_docs)

    @F.arrow_udf("string")
    def masked(text: pa.Array) -> pa.Array:
        give_back()
        given = text.to_pylist()
        clean = [t or "" for t in given]
        return pa.array([None if g is None else mask(t, s) for g, t, s in zip(given, clean, scan_batch(clean, tagger))],
                        type=pa.string())

    return masked(docs["text"])
