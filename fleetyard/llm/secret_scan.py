"""Secret scan: patterns, and assignment-aware lexing of names and literals.

Around every assignment operator (``=``, ``:=``, ``=>``, ``:``) of a text the
lexer reads a name to the left and an expression to the right: quoted or bare
literals and other names, joined by ``+``. That covers source code, shell,
INI, YAML, JSON and properties files. Names are bound in text order;
an expression of names stands for the literals they are bound to, so in
``k = "f3ef..."`` followed by ``db_password = k`` the literal of ``k`` is
scored by the name ``db_password``. A literal's score is the sensitivity of
the target name times how much the literal looks random (length, character
classes, entropy, not a placeholder); literals scoring MIN_SCORE or more are
added as spans of kind ``literal`` where no pattern's span overlaps them.

A text's spans depend on that text alone. Null and empty texts have none;
repeated rows each get their own result; a null id stays null.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetyard.llm.frames import column, map_batches, texts

KINDS = ("assign", "access", "hex", "literal")
MIN_SCORE = 0.5

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_OPERATOR = re.compile(r"=>|:=|[=:]")
# The name left of an operator, read from the operator back: each character is seen once.
_LEFT = re.compile(r"""[\x20\t]*["']?([A-Za-z0-9_.\-]*[A-Za-z_])""")
_TERM = re.compile(r"""[\x20\t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|([^\s"',;#(){}\[\]<>+]+))""")
_PLUS = re.compile(r"[\x20\t]*\+")
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*\Z")
_PLACEHOLDER = re.compile(r"\$\{|\{\{|<.*>|(?:change|replace|example|sample|dummy|your|todo|none|null|true|false|test)|(.)\1{5}",
                          re.IGNORECASE)
# How sensitive a target name is, by the parts of the name.
_SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0,
              "apikey": 1.0, "api_key": 1.0, "access_key": 1.0, "private_key": 1.0, "credential": 0.9,
              "credentials": 0.9, "auth": 0.7, "signature": 0.6, "salt": 0.6, "key": 0.6, "bearer": 0.9}
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def pattern_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the three patterns, leftmost and non-overlapping within a kind."""
    out: dict[str, list[tuple[int, int]]] = {"assign": [], "access": [], "hex": []}
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            out["assign"] = [m.span() for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out["access"] = [m.span() for m in _ACCESS.finditer(text)]
    out["hex"] = [m.span() for m in _HEX.finditer(text)]
    return out


def name_sensitivity(name: str) -> float:
    """0 to 1, by the words of a snake, kebab, dotted or camel case name."""
    flat = _CAMEL.sub("_", name).lower().replace("-", "_").replace(".", "_")
    parts = flat.split("_")
    pairs = ["_".join(p) for p in zip(parts, parts[1:])]
    return max((_SENSITIVE.get(p, 0.0) for p in [*parts, *pairs]), default=0.0)


def literal_randomness(value: str) -> float:
    """0 to 1: how much a literal looks like a generated secret."""
    n = len(value)
    if n < 6 or _PLACEHOLDER.search(value) or re.search(r"\s", value):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.0) * min(1.0, n / 12.0) * (1.0 if classes >= 2 else 0.55)


def lex_assignments(text: str) -> list[tuple[str, list[tuple[int, int]]]]:
    """(name, spans of the literals assigned to it), in text order, constants propagated."""
    bound: dict[str, list[tuple[int, int]]] = {}
    out = []
    back = text[::-1]
    for op in _OPERATOR.finditer(text):
        if text.startswith("//", op.end()) or text.startswith("==", op.start()) or text.startswith("::", op.start()):
            continue
        left = _LEFT.match(back, len(text) - op.start())
        if left is None:
            continue
        at, values = op.end(), []
        while True:
            term = _TERM.match(text, at)
            if term is None:
                break
            group = term.lastindex
            if group == 3 and _IDENT.match(term.group(3)) and term.group(3) in bound:
                values += bound[term.group(3)]
            else:
                values.append(term.span(group))
            at = term.end()
            plus = _PLUS.match(text, at)
            if plus is None:
                break
            at = plus.end()
        if values:
            values = list(dict.fromkeys(values))
            name = left.group(1)[::-1]
            bound[name] = values
            out.append((name, values))
    return out


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Literals assigned to sensitive names, scored over all they are assigned to."""
    if "=" not in text and ":" not in text:
        return []
    best: dict[tuple[int, int], float] = {}
    for name, values in lex_assignments(text):
        weight = name_sensitivity(name)
        if weight:
            for span in values:
                best[span] = max(best.get(span, 0.0), weight)
    return sorted(s for s, w in best.items() if w * literal_randomness(text[s[0]:s[1]]) >= MIN_SCORE)


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind."""
    base = pattern_spans(text)
    spans = [(k, a, b) for k, found in base.items() for a, b in found]
    spans += [("literal", a, b) for a, b in literal_spans(text)
              if not any(a < y and x < b for _, x, y in spans)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, n_literal long, "
          "base_sha256 string, spans string")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts, digest of the pattern spans, all spans."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for raw in column(batch, "text").to_pylist():
            spans = scan((raw or b"").decode("utf-8", "replace"))
            n = Counter(k for k, _, _ in spans)
            base = joined([s for s in spans if s[0] != "literal"])
            rows.append((*(n[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
        cols = list(zip(*rows)) if rows else [[]] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id")] + [pa.array(c, t) for c, t in zip(cols, types)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"])

    return map_batches(texts(docs), run, SCHEMA)
