"""SentencePiece models through the tokenizers library.

``parse_model`` reads the model's protobuf; ``build_tokenizer`` rebuilds it:
the normaliser (precompiled character map, white space rules), the metaspace
marker with its dummy prefix, unigram scores or, for a BPE model, the merges
that the scores imply, and byte fallback. Words are encoded in batches on
several threads, each distinct word once for a task (``WordMemo``), and every
new word's ids are verified against the sentencepiece library; where the two
differ (ties between equal scores) sentencepiece's ids stand and the word is
counted as repaired, so the result is always sentencepiece's own.

Words are cut before a run of spaces and around line feeds. That is exact for
models without a character map or white space removal and without a piece that
has a marker after another character or holds a line feed (``word_safe``);
other models, and texts holding the marker itself, are encoded whole.

A null or empty text has no ids and decodes to the empty text; repeated rows
each have their own result; a null id stays null.
"""
from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_batches, texts
from fleetyard.llm.word_memo import WordMemo, ragged
from fleetyard.llm.words import chunks

MARK = "▁"
THREADS = 2
# Piece types and model kinds of the published model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    char_map: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True

    def word_safe(self) -> bool:
        return (not self.char_map and not self.remove_extra and self.dummy_prefix
                and not any(MARK in p.lstrip(MARK) or "\n" in p
                            for p, t in zip(self.pieces, self.types) if t in (NORMAL, USER_DEFINED))
                and USER_DEFINED not in self.types)


def _fields(raw: bytes):
    """(number, value) of a protobuf message: ints, or bytes of fixed and nested values."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, raw[at:at + size]
        at += size


def parse_model(raw: bytes) -> Model:
    m = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL, **dict(_fields(value))}
            m.pieces.append(piece[1].decode("utf-8"))
            m.scores.append(struct.unpack("<f", piece[2])[0])
            m.types.append(piece[3])
        elif number == 2:
            spec = dict(_fields(value))
            m.kind, m.byte_fallback, m.unk_id = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), spec.get(40, 0)
        elif number == 3:
            spec = dict(_fields(value))
            m.char_map = spec.get(2, b"")
            m.dummy_prefix, m.remove_extra = bool(spec.get(3, 1)), bool(spec.get(4, 1))
    return m


def implied_merges(m: Model) -> list[tuple[str, str]]:
    """All splits of normal pieces into two pieces, best score of the whole first."""
    known = {p for p, t in zip(m.pieces, m.types) if t == NORMAL}
    out = []
    for n, (piece, kind) in enumerate(zip(m.pieces, m.types)):
        if kind == NORMAL:
            for cut in range(1, len(piece)):
                if piece[:cut] in known and piece[cut:] in known:
                    out.append((-m.scores[n], n, cut, (piece[:cut], piece[cut:])))
    return [pair for _, _, _, pair in sorted(out)]


def build_tokenizer(m: Model, prefix: bool = True):
    """The model as a tokenizers.Tokenizer; ``prefix``: add the dummy prefix itself."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if m.kind == UNIGRAM:
        core = models.Unigram(list(zip(m.pieces, m.scores)), m.unk_id, m.byte_fallback)
    else:
        core = models.BPE({p: n for n, p in enumerate(m.pieces)}, implied_merges(m),
                          unk_token=m.pieces[m.unk_id], fuse_unk=True, byte_fallback=m.byte_fallback)
    tok = Tokenizer(core)
    steps = [normalizers.Precompiled(m.char_map)] if m.char_map else []
    if m.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tok.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(),
                                     decoders.Fuse(), decoders.Strip(" ", 1, 0)])
    return tok


def piece_bytes(m: Model) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 text of every id, as one buffer, and the offsets."""
    out = []
    for piece, kind in zip(m.pieces, m.types):
        if kind == BYTE:
            out.append(bytes([int(piece[3:5], 16)]))
        elif kind in (CONTROL, UNKNOWN):
            out.append(b"" if kind == CONTROL else " ⁇ ".encode())
        else:
            out.append(piece.replace(MARK, " ").encode())
    ends = np.concatenate([[0], np.cumsum([len(x) for x in out])])
    return np.frombuffer(b"".join(out), dtype=np.uint8), ends


def split_marked(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut before every run of spaces and around line feeds; nothing is left out."""
    n = len(buf)
    begin = np.zeros(n + 1, dtype=bool)
    if n:
        space, feed = buf == 0x20, buf == 0x0A
        begin[1:n] = space[1:] & ~space[:-1] | feed[1:] | feed[:-1]
        marks = (buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)
        for at in np.flatnonzero(marks):           # a text with the marker itself stays whole
            t = int(np.searchsorted(bounds, at, side="right")) - 1
            begin[bounds[t] + 1:bounds[t + 1]] = False
        begin[bounds] = True
        begin[n] = False
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, bounds, side="left")


class Codec:
    """Encoder and decoder of one model in one task's process."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.spm = sentencepiece.SentencePieceProcessor(model_file=path)
        self.safe = self.model.word_safe()
        self.tok = build_tokenizer(self.model, prefix=not self.safe)
        self.repaired = 0
        self.memo = WordMemo(self._words)
        self.bytes, self.ends = piece_bytes(self.model)

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of words whose leading spaces are part of them, verified."""
        mine = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        # sentencepiece adds the marker itself: take off one leading space, or the marker's id
        lead = [w[1:] if w.startswith(" ") else w for w in words]
        theirs = self.spm.encode(lead, num_threads=1)
        for n, (a, b) in enumerate(zip(mine, theirs)):
            if words[n].startswith(" "):
                want = b if lead[n] else [self.space_id]
            else:
                want = b[1:] if b and b[0] == self.space_id else None
            if want is not None and a != want:
                mine[n] = want
                self.repaired += 1
        return mine

    @property
    def space_id(self) -> int:
        return self.spm.piece_to_id(MARK)

    def encode(self, column_: pa.Array):
        """For every chunk: (first row, ids, offsets of the texts, marked bytes, their offsets)."""
        if self.safe:
            if column_.null_count:
                column_ = column_.fill_null(b"")
            marked = pc.if_else(pc.equal(pc.binary_length(column_), 0), b"",
                                pc.binary_join_element_wise(pa.scalar(b" "), column_, pa.scalar(b"")))
            for c in chunks(marked, split=split_marked):
                yield c.first, *self.memo.texts(c), c.buf, c.bounds
        else:
            for c in chunks(column_):
                t = [c.buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(c.bounds[:-1], c.bounds[1:])]
                found = self.tok.encode_batch_fast(t, add_special_tokens=False)
                found = [want if e.ids != want else e.ids for e, want in zip(found, self.spm.encode(t, num_threads=1))]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
                yield c.first, np.array([i for x in found for i in x], np.int32), ends, None, None

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the ids' pieces (marker as space, dummy prefix still there), text offsets."""
        lengths = self.ends[ids + 1] - self.ends[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.bytes[ragged(self.ends[ids], lengths)], total[offsets]


_CODECS: dict[str, Codec] = {}


def codec(path: str, threads: int = THREADS) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path, threads)
    return _CODECS[path]


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids (array of int) of every row's whole text."""

    def run(batch: pa.RecordBatch):
        doc = column(batch, "doc_id")
        for first, ids, ends, _, _ in codec(model).encode(column(batch, "text")):
            yield pa.RecordBatch.from_arrays(
                [doc.slice(first, len(ends) - 1),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))],
                names=["doc_id", "ids"])

    return map_batches(texts(docs), run, "doc_id long, ids array<int>")


def decode_ids(tokens: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of every row of ids (null ids: empty)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = column(batch, "ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
        raw, at = codec(model).decode(flat, ends)
        text = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array([t[1:] if t.startswith(" ") else t for t in text], pa.string())],
            names=["doc_id", "text"])

    return map_batches(tokens.select("doc_id", "ids"), run, "doc_id long, text string")


def piece_digest(docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every row: doc_id, n_tokens, ids_crc32 (of little-endian
    unsigned 32-bit ids), round_trip (the decoded text is the text)."""

    def run(batch: pa.RecordBatch):
        doc, own = column(batch, "doc_id"), column(batch, "text")
        coder = codec(model)
        for first, ids, ends, buf, bounds in coder.encode(own):
            raw, at = coder.decode(ids.astype(np.int64), ends)
            wide = ids.astype("<u4")
            span = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
            if buf is not None:
                same = [bool(np.array_equal(raw[a:b], buf[x:y])) for a, b, x, y in
                        zip(at[:-1].tolist(), at[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]
            else:
                given = [t or b"" for t in own.slice(first, len(span)).to_pylist()]
                same = [raw[a:b].tobytes().removeprefix(b" ") == g for a, b, g in zip(at[:-1], at[1:], given)]
            yield pa.RecordBatch.from_arrays(
                [doc.slice(first, len(span)), pa.array([b - a for a, b in span], pa.int64()),
                 pa.array([zlib.crc32(wide[a:b]) for a, b in span], pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    return map_batches(texts(docs), run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def with_ids(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row: the training-ready table."""
    return encode_texts(docs, model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
