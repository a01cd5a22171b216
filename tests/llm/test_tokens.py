"""Token files and SentencePiece: exact round trips and parity with the libraries."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fleetyard.llm import sentence_pieces, token_files
from fleetyard.llm.words import chunks
from tests.llm.conftest import multiset

P = pytest.importorskip("public_tokenizers")
BPE, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ALPHABET = list("abcXYZ 09 \n\t.,'!?-_=<|>éÉ×÷…—KİΣς中 \u0085 \U0001f600&$") + ["́", "̈", "'s", "don't", "<|endoftext|>", "한", "하", "    "]


def odd_texts(n, seed, mark=False):
    r = random.Random(seed)
    letters = ALPHABET + ["▁"] * mark
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("most", [200, 60_000, 1 << 32])
def test_codec_round_trip(most):
    r = np.random.default_rng(most % 97)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        ranks = r.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert token_files.decode_ranks(control, data, n).tolist() == ranks.tolist()
    edge = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], dtype=np.uint32)
    control, data = token_files.encode_ranks(edge)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 and token_files.decode_ranks(control, data, 8).tolist() == edge.tolist()


def test_word_by_word_encoding_is_the_tokenizers(tmp_path):
    from tokenizers import Tokenizer

    tok, memo = Tokenizer.from_file(BPE), token_files._memo(BPE)
    given = odd_texts(3000, 3)
    got = []
    for at in range(0, len(given), 7):
        for c in chunks(pa.array(given[at:at + 7]), lower=True, split=token_files._pieces):
            ids, ends = memo.texts(c)
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in given]


def test_memo_starts_afresh():
    from fleetyard.llm.word_memo import WordMemo

    memo = WordMemo(lambda words: [[len(w)] * (i % 3) for i, w in enumerate(words)], max_words=8, max_ids=4)
    plain = WordMemo(lambda words: [[len(w)] for w in words], max_words=8, max_ids=4)
    for t in ("a bb ccc " * 3, " ".join("x" * i for i in range(1, 200)), "a bb"):
        for c in chunks(pa.array([t, "", t])):
            memo.texts(c)
            ids, ends = plain.texts(c)
            assert ids.tolist() == [len(w) for x in (t, "", t) for w in x.split()] and len(ends) == 4


def test_token_files(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    got = [tuple(r) for r in token_files.token_file_digest(docs, BPE, 2).collect()]
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
    start, want = 0, []
    for d, x in ids:
        want.append((d, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert sorted(got, key=lambda x: x[1]) == want
    assert token_files.token_file_digest(empty, BPE).count() == 0


def test_model_is_rebuilt():
    import sentencepiece

    spm = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(PIECES, "rb") as f:
        m = sentence_pieces.parse_model(f.read())
    assert m.pieces == [spm.id_to_piece(i) for i in range(spm.get_piece_size())]
    assert m.word_safe() and m.byte_fallback and m.unk_id == spm.unk_id()
    full = sentence_pieces.build_tokenizer(m)
    for t in odd_texts(500, 9):
        if t and "  " not in t:
            assert full.encode(t, add_special_tokens=False).ids == spm.encode(t), t
            assert full.decode(full.encode(t, add_special_tokens=False).ids) == spm.decode(spm.encode(t))


def test_pieces_are_sentencepieces_own():
    import sentencepiece

    spm, coder = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.codec(PIECES)
    given = odd_texts(2000, 4, mark=True)
    for at in range(0, len(given), 5):
        part = given[at:at + 5]
        got = []
        for _, ids, ends, _, _ in coder.encode(pa.array([t.encode() for t in part], pa.binary())):
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == spm.encode(part)


def test_whole_text_path(monkeypatch):
    import sentencepiece

    spm = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(sentence_pieces.Model, "word_safe", lambda self: False)
    coder = sentence_pieces.Codec(PIECES)
    given = odd_texts(60, 6)
    for _, ids, ends, _, _ in coder.encode(pa.array([t.encode() for t in given], pa.binary())):
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == spm.encode(given)


def test_sentence_pieces_on_documents(docs, rows, empty):
    import sentencepiece

    spm = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = multiset(sentence_pieces.piece_digest(docs, PIECES), "doc_id", "n_tokens", "ids_crc32", "round_trip")
    ids = [(d, spm.encode(t or "")) for d, t in rows]
    assert got == sorted(((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), True) for d, x in ids), key=repr)
    table = sentence_pieces.with_ids(docs, PIECES)
    back = sentence_pieces.decode_ids(table, PIECES)
    assert multiset(back, "doc_id", "text") == sorted(((d, t or "") for d, t in rows), key=repr)
    assert sentence_pieces.piece_digest(empty, PIECES).count() == 0 == sentence_pieces.with_ids(empty, PIECES).count()
