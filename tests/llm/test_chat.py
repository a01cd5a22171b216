import hashlib
import random
from collections import defaultdict

import pytest

from fleetyard.llm.chat_format import PART, PROBE, Template, chat_digest, event_log, fold, parse, render, with_probe

ODD = ["", None, "\\", "\\\\|", "<|done|>\n", "<<|done|>\n", "<\\|text|>", "<|", "a\nb", "<|turn|>user<|text|>x<|done|>",
       "\U0001f600<|done|>é", "|done|>\n", "x" * 3000]


def plain_fold(events):
    """events: (conv, message, seq, kind, body). {(conv, message): (role, text)}"""
    by = defaultdict(set)
    for c, *e in events:
        by[c].add(tuple(e))
    out = {}
    for c, es in by.items():
        state, role = {}, {}
        for m, seq, kind, body in sorted(es, key=lambda e: (e[1], e[2], e[3] or "")):
            if kind in ("edit", "regenerate"):
                state = {k: v for k, v in state.items() if k < m}
                state[m] = body or "" if kind == "edit" else ""
            elif kind == "delta":
                state[m] = state.get(m, "") + (body or "")
            elif kind == "open":
                state.setdefault(m, "")
                role[m] = body or ""
        out.update({(c, m): (role.get(m, ""), t) for m, t in state.items()})
    return out


def random_log(seed, n=1500):
    r = random.Random(seed)
    log = []
    for seq in range(n):
        kind = r.choices(["open", "delta", "edit", "regenerate", "note"], [3, 8, 1, 1, 1])[0]
        body = r.choice(["user", "assistant", None]) if kind == "open" else None if kind == "regenerate" else r.choice(ODD + ["hi", " you"])
        log.append((r.choice([None, 1, 2, 3, 4, 5]), r.randint(0, 400), seq, kind, body))
    return log + log[::7]


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_is_the_plain_replay(spark, seed):
    log = random_log(seed)
    df = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, body string").repartition(5)
    got = {(x.p.conv_id, x.message): (x.role, x.text) for x in fold(df).collect()}
    # the role of the last opening counts, also of one before a reset; replay in the same way
    assert got == plain_fold(log)


def digest_of(rows):
    out = {}
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append(((turn is not None, turn or 0), role or "", text or ""))
    for c, ts in by.items():
        ts.sort()
        loss = "".join(t for _, r, t in ts if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in ts)

        def esc(t):
            t = t.replace("\\", "\\\\")
            for m in Template().marks:
                t = t.replace(m, "<\\" + m[1:])
            return t

        chars = sum(len("<|turn|><|text|><|done|>\n") + len(esc(r)) + len(esc(t)) for _, r, t in ts)
        out[c] = (len(ts), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def turns(spark, rows):
    full = [(*x, "a", i) for i, x in enumerate(rows)]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, copy string, part long").repartition(3)


def test_digest_of_odd_conversations(spark):
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a\nb", "<|text|>"]), r.choice(ODD))
            for c in range(12) for t in range(r.randint(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", r.choice(ODD)) for t in range(500)]         # a long one
    rows += [(51, 3, "user", "same")] * (2 * PART + 5) + [(51, 3, "assistant", "other"), (51, None, "user", "first")]
    rows += [(None, None, None, None), (None, None, None, None), (None, 1, "assistant", "x")]
    out = chat_digest(with_probe(turns(spark, rows)))
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256, x.formatted_chars) for x in out.collect()}
    assert got == digest_of([*rows, (-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)])


def test_empty_table_has_the_probe_only(spark):
    assert [x.conv_id for x in chat_digest(with_probe(turns(spark, [(1, 1, "u", "x")]).limit(0))).collect()] == [-7]


def test_parts_and_mask(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text <|done|>\n {t}") for t in range(3 * PART)]
    t = Template("[T]", "[X]", "[E]")
    log = event_log(turns(spark, rows))
    assert {x.kind for x in log.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate"}
    parts = render(fold(log, ("turn", "copy"), ("turn", "copy", "step")), ("turn", "copy"), t)
    got = parse(parts, t).orderBy("block", "part").collect()
    assert len(got) == 3 and all(p.n_turns == len(p.turns) == PART for p in got)
    assert [tuple(x) for p in got for x in p.turns] == [x[2:] for x in rows]
    assert [x for p in got for x in p.learnt] == [x[3] for x in rows if x[2] == "assistant"]


def test_marks_must_not_overlap():
    for marks in (("aa", "b", "c"), ("<a", "x<", "<e"), ("\\a", "b", "c"), ("", "b", "c")):
        with pytest.raises(ValueError):
            Template(*marks)


def test_no_python_in_the_plan(spark):
    plan = chat_digest(with_probe(turns(spark, [(1, 1, "user", "x")])))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_query_matches_its_sql(spark):
    import duckdb

    from fleetyard.llm.queries import ORACLE_SQL, QUERIES
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    out = QUERIES["op11_chat_format"](spark, d)
    want = duckdb.sql(ORACLE_SQL["op11_chat_format"])
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(want.fetchall())
