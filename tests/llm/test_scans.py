"""Secret scan, personal data, decontamination and quality rules against plain versions."""
import random

import numpy as np

from fleetyard.llm import decontamination, pii, quality_rules, secret_scan
from tests.llm import brute
from tests.llm.conftest import SF, frame, multiset

ALPHABET = list("ab1209 .:=@+-()\"'\nAKIZ,_é") + ["password", "Token = ", "api_key:", "AKIA", "deadbeef0123", "4111 1111 1111 1111",
                                                "10.0.0.7", "+1 (017) 555-7713", "jo.x@mail.example.com", "SECRET='", "255."]


def odd_texts(n=400, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_secret_patterns():
    for t in [*odd_texts(), "AKIA" + "A1" * 9, "f" * 24, "f" * 23, "token=abcdef", "token=abcde", "TOKEN: 'x-y-z-1'", ""]:
        base = [s for s in secret_scan.scan(t) if s[0] != "literal"]
        assert base == brute.secret_spans(t), t


def test_secret_constants_are_propagated():
    t = 'key_part = "Zx9-Qm2-Lp7-Vt4"\nregion = "eu-west"\ndb_password = key_part\n{"clientSecret": "aB3$kk9_zzT1pq"}\npassword = "changeme-please"'
    spans = [(k, t[a:b]) for k, a, b in secret_scan.scan(t)]
    assert ("literal", "Zx9-Qm2-Lp7-Vt4") in spans
    assert any("aB3" in s for _, s in spans)
    assert not any(k == "literal" and "changeme" in s for k, s in spans)
    assert not any("eu-west" in s for _, s in spans)
    joined = 'a = "Zx9Qm2Lp" + "7Vt4Kk1Ww"\nsecret = a'
    assert [s for k, s in [(k, joined[x:y]) for k, x, y in secret_scan.scan(joined)]] == ["Zx9Qm2Lp", "7Vt4Kk1Ww"]


def test_secret_query_columns(docs, rows, empty):
    got = multiset(secret_scan.secret_spans(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for d, t in rows:
        s = brute.secret_spans(t)
        want.append((d, *(sum(k == x for k, _, _ in s) for x in ("assign", "access", "hex")), brute.sha(s)))
    assert got == sorted(want, key=repr)
    assert secret_scan.secret_spans(empty).count() == 0


def test_pii_patterns():
    for t in [*odd_texts(seed=8), "1.2.3.4.5", "256.1.1.1", "0001.2.3.4", "a@b", "a@@b.c", "x@y.z@w.v", "+123456789", "+1" + "2" * 15,
              "4111-1111-1111-1111 4111", "9" * 5000, "a" * 3000 + "@b.c", "+1 " * 50, ""]:
        assert pii.pattern_spans(t) == brute.pii_spans(t), t[:80]


def test_tagger_learns_held_out_formats(spark):
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
            .filter("text rlike '[0-9@]' and length(text) < 3000").orderBy("doc_id").limit(500).collect()]
    train, held = rows[:250], rows[250:]
    t = pii.Tagger.new(9)
    losses = t.fit(*pii.training_windows(train))
    assert losses[-1] < 0.1 * losses[0]
    found = total = 0
    for text in held:
        for kind, a, b in brute.pii_spans(text):
            # the same datum in a format that the patterns don't know
            if kind == "phone":
                d = "".join(c for c in text[a:b] if c.isdigit())[:11]
                s = f"({d[1:4]}) {d[4:7]}-{d[7:]}"
                if len(d) < 10:
                    continue
                new = text[:a] + s + text[b:]
                total += 1
                found += ("phone", a, a + len(s)) in pii.scan_batch([new], t)[0]
    assert total >= 5 and found >= 0.7 * total
    clean = [x for x in held if not brute.pii_spans(x)]
    extra = sum(len(s) for s in pii.scan_batch(clean, t))
    assert extra <= 0.05 * max(20, len(clean))
    for text, spans in zip(held, pii.scan_batch(held, t)):
        assert [s for s in brute.pii_spans(text)] == [s for s in spans if s in pii.pattern_spans(text)]


def test_emails_without_digit_or_at_sign_are_masked(spark):
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
            .filter("text rlike '[0-9@]' and length(text) < 3000").orderBy("doc_id").limit(400).collect()]
    tagger = pii.Tagger.new(9)
    tagger.fit(*pii.training_windows(rows))
    text = "the notes of this meeting are for all to read and more of them will come soon to the list of people "
    found = total = 0
    for address in ("jane.doe[at]mail.example.com", "theman.is[at]mail.example.com", "peter.other(at)mail.example.com"):
        for lead in range(0, 96, 5):        # its start at many places of a tile
            t = text[-lead:] * (lead > 0) + "write to " + address + " " + text
            assert not any(c.isdigit() or c == "@" for c in t)
            spans = pii.scan_batch([t], tagger)[0]
            total += 1
            found += ("email", t.index(address), t.index(address) + len(address)) in spans and address not in pii.mask(t, spans)
    assert found >= 0.7 * total


class Fixed:
    """Tags every place of given texts by a rule on the symbols: an email is a run without spaces holding a bracket."""

    def decode(self, ids):
        tags = np.zeros(ids.shape, dtype=np.int8)
        for row, out in zip(ids, tags):
            t = 0
            while t < len(row):
                end = t
                while end < len(row) and row[end] > 1:
                    end += 1
                if end - t > 8:
                    out[t:end] = 2
                    out[t] = 1
                t = max(end, t + 1)
        return tags


def test_long_spans_go_on_in_later_windows():
    for n in (5, 30, 34, 63, 65, 90):
        for lead in range(0, 70, 3):
            address = "a" * n + "[at]" + "b" * n + ".example.com"
            t = "x " * (lead // 2) + " " * (lead % 2) + address + " y"
            a = t.index(address)
            assert pii.scan_batch([t], Fixed()) == [[("email", a, a + len(address))]], (n, lead)
    t = "a" * 40 + "(at)" + "b" * 12 + ".example.org"      # at the text's end
    assert pii.scan_batch([t, "", "no address"], Fixed()) == [[("email", 0, len(t))], [], []]


def test_pii_query_and_mask(docs, rows, empty):
    got = multiset(pii.pii_spans(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    want = []
    for d, t in rows:
        s = brute.pii_spans(t)
        want.append((d, *(sum(k == x for k, _, _ in s) for x in pii.KINDS), brute.sha(s)))
    assert got == sorted(want, key=repr)
    assert pii.pii_spans(empty).count() == 0
    assert pii.mask("a b@c.d e", [("email", 2, 7)]) == "a [EMAIL] e"
    assert pii.mask("0123456789", [("card", 2, 6), ("phone", 4, 8)]) == "01[CARD]89"


def test_viterbi_and_gradient():
    from fleetyard.llm.char_tagger import Tagger

    r = np.random.default_rng(0)
    t = Tagger.new(3, emb=3, hidden=2)
    t.w = {k: v.astype(np.float64) for k, v in t.w.items()}
    t.w["trans"] = r.normal(size=(3, 3))
    ids, tags = r.integers(0, 98, (2, 5)), r.integers(0, 3, (2, 5))
    u = t.scores(ids.T)
    import itertools

    for b in range(2):
        def path(p):
            return t.w["first"][p[0]] + sum(u[i, b, p[i]] for i in range(5)) + sum(t.w["trans"][p[i], p[i + 1]] for i in range(4))
        assert max(itertools.product(range(3), repeat=5), key=path) == tuple(t.decode(ids)[b])
    loss, grad = t._loss(ids.T, tags.T)
    for k in ("Whf", "Wxb", "Wo", "trans", "emb", "bf", "first"):
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old, eps = t.w[k][at], 1e-3
        t.w[k][at] = old + eps
        up = t._loss(ids.T, tags.T)[0]
        t.w[k][at] = old - eps
        down = t._loss(ids.T, tags.T)[0]
        t.w[k][at] = old
        assert abs((up - down) / (2 * eps) - grad[k][at]) < 2e-2 * max(1.0, abs(grad[k][at])), k


def leak_rows():
    r = random.Random(5)
    v = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    line = lambda n: [r.choice(v) for _ in range(n)]
    items = [(i, " ".join(line(n))) for i, n in enumerate((12, 30, 30, 45, 20, 5))] + [(6, "only three words"), (7, None), (8, "")]
    items.append((1, items[1][1]))
    rows = []
    for d in range(60):
        w = line(r.randint(0, 120))
        if d % 3 == 0:
            it = items[r.randrange(6)][1].split()
            for _ in range(r.randint(0, 2)):
                it[r.randrange(len(it))] = r.choice(v)
            if d % 6 == 0 and len(it) > 8:
                del it[3]
            at = r.randint(0, len(w))
            w[at:at] = it
        rows.append((d, " ".join(w).upper() if d % 5 == 0 else " ".join(w)))
    rows += [(100, "Only three words"), (101, "only three words more"), (102, None), (103, ""), (None, items[3][1]),
             (104, items[2][1]), (104, items[2][1]), (105, " ".join(line(20000)) + " " + items[1][1]),
             (106, " ".join(items[3][1].split()[:40]))]
    return rows, items


def test_decontamination(spark, empty):
    rows, items = leak_rows()
    want = brute.leaks(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_leaks(frame(spark, rows), bench)
    assert multiset(got.selectExpr("doc_id", "item_id", "round(similarity, 9) s"), "doc_id", "item_id", "s") == sorted(
        ((rows[r][0], items[i][0], round(s, 9)) for (r, i), s in want.items()), key=repr)
    df = frame(spark, rows)
    left = df.filter(~decontamination.leaks_any(df, bench))
    assert sorted((r["doc_id"], r["text"]) for r in left.filter("doc_id is not null").collect() if r["text"]) == sorted(
        (d, t) for n, (d, t) in enumerate(rows) if d is not None and t and not any((n, i) in want for i in range(len(items))))
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(df, bench.limit(0)).count() == 0
    assert df.filter(~decontamination.leaks_any(df, bench.limit(0))).count() == len(rows)


def test_decontamination_in_item_blocks(spark, monkeypatch):
    rows, items = leak_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = multiset(decontamination.find_leaks(frame(spark, rows), bench), "doc_id", "item_id", "similarity", "start")
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 300)
    blocks = decontamination.item_blocks
    monkeypatch.setattr(decontamination, "item_blocks", lambda b: blocks(b, 300))
    assert multiset(decontamination.find_leaks(frame(spark, rows), bench), "doc_id", "item_id", "similarity", "start") == whole


def test_block_tables_find_all_within_the_radius():
    r = np.random.default_rng(6)
    prints = r.integers(0, 1 << 63, 50, dtype=np.uint64)
    near = prints[r.integers(0, 50, 300)].copy()
    for n in range(300):
        for b in r.choice(64, r.integers(0, 28), replace=False):
            near[n] ^= np.uint64(1) << np.uint64(b)
    w, i = decontamination.LengthIndex.of(np.arange(50), prints, 20, 8).within(near, 20)
    want = {(a, b) for a in range(300) for b in range(50) if int(near[a] ^ prints[b]).bit_count() <= 20}
    assert set(zip(w.tolist(), i.tolist())) == want


def test_quality_rule_counts(docs, rows, labels, empty, no_labels):
    df = quality_rules.quality_rules(docs, labels)
    got = multiset(df, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((d, *brute.rule_counts(t), brute.base_failed(t)) for d, t in rows), key=repr)
    assert df.filter("base_failed and kept").count() == 0
    assert quality_rules.quality_rules(empty, labels).count() == 0
    plain = quality_rules.quality_rules(docs, no_labels)          # nothing trusted: the rules alone
    assert plain.filter("kept = base_failed or score != 0").count() == 0


def test_log_ratio_counts_match_brute_force(spark, docs, rows, labels):
    import math
    import re

    good = {r["doc_id"] for r in labels.filter("quality = 1 and doc_id is not null").collect()}
    trusted, raw = quality_rules.count_grams(docs, labels)
    n_trusted = n_raw = 0
    for d, t in rows:
        tokens = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+|[^\sA-Za-z0-9\u0080-\U0010ffff]+", t or "", re.ASCII)
        n = max(0, 2 * len(tokens) - 1)
        n_raw += n
        n_trusted += n if d in good else 0
    assert (trusted.sum(), raw.sum()) == (n_trusted, n_raw)
    w = quality_rules.log_ratio(trusted, raw)
    assert math.isclose(float(((raw + 1) / (raw.sum() + len(raw)) * np.exp(w)).sum()), 1.0, rel_tol=1e-9)


def test_quality_verdicts_on_labelled_documents(spark):
    sf = SF.replace("0.001", "0.01")
    docs_, labels_ = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    j = quality_rules.quality_rules(docs_, labels_).join(labels_, "doc_id").filter("not base_failed")
    assert j.filter("quality = 1 and not kept").count() == 0
    assert j.filter("quality = 0 and kept").count() <= 0.1 * j.filter("quality = 0").count()


def test_keep_good_keeps_columns(docs, labels):
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    judged = quality_rules.quality_rules(docs, labels).filter("kept").count()
    assert kept.count() == judged


def test_secret_names_of_any_length():
    name = "db_passphrase_" + "a" * 130
    t = f'{name} = "Zx9Qm2Lp7Vt4Kk1Ww"\n' + "x" * 5000 + "=1\n" + f"secret_copy = {name}"
    assert [n for n, _ in secret_scan.lex_assignments(t)] == [name, "x" * 5000, "secret_copy"]
    assert [t[a:b] for k, a, b in secret_scan.scan(t) if k == "literal"] == ["Zx9Qm2Lp7Vt4Kk1Ww"]


def test_short_items_inside_long_documents(spark):
    rows = [(1, "some words then the secret phrase again and the secret phrase once more " * 3), (2, "the secret phrases"),
            (3, "phrase"), (4, "one"), (5, None), (6, "the secret"), (7, "Secret PHRASE")]
    items = [(10, "The secret phrase"), (11, "phrase"), (12, "secret phrase"), (13, "the secret phrase again and"), (14, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.similarity, x.start) for x in decontamination.find_leaks(frame(spark, rows), bench).collect()}
    want = {(rows[r][0], items[i][0]): s for (r, i), s in brute.leaks(rows, items).items()}
    assert {k: s for k, (s, _) in got.items()} == want
    assert got[1, 10] == (1.0, 3) and got[1, 11][1] == 5 and (7, 12) in got and (2, 10) not in got
