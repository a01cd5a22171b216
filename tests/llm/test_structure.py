import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fleetyard.llm import structure_repair as sr
from fleetyard.llm.structure_repair import cheapest, damaged, repair, repair_digest

SPACE = " \t\n\x0b\f\r"
GO = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def plain(rows):
    """rows: (role, text) in order. (blank, duplicate, truncated, illegal, cost, audit, repaired)"""
    faults, seen = [], set()
    for role, text in rows:
        shown = text.rstrip(SPACE)
        faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "", ())}

    def offer(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserts(into):
        for _ in range(3):
            for s, (c, a, t) in list(into.items()):
                to = 3 if s == 2 else 2
                offer(into, to, (c + 5, a + "I", (*t, ("assistant" if to == 3 else "user", ""))))

    for (role, text), fault in zip(rows, faults):
        inserts(best)
        new = {}
        for s, (c, a, t) in best.items():
            offer(new, s, (c + 2, a + "D", t))
            if fault not in ("b", "d"):
                extra = 5 if fault == "t" else 0
                if (s, role[:1]) in GO:
                    offer(new, GO[s, role[:1]], (c + extra, a + "K", (*t, (role, text))))
                to = 3 if s == 2 else 2
                offer(new, to, (c + extra + 1, a + "R", (*t, ("assistant" if to == 3 else "user", text))))
        best = new
    inserts(best)
    cost, audit, turns = min(best[s] for s in (0, 3) if s in best)
    illegal = sum(1 for x, y in zip(rows, rows[1:]) if x[0][:1] + y[0][:1] not in ("su", "ua", "au"))
    return (faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, turns)


def codes_of(rows):
    out, seen = [], set()
    for role, text in rows:
        shown = text.rstrip(SPACE)
        fault = sr.BLANK if not shown else sr.DUPLICATE if (role, text) in seen else 0 if shown[-1] in ".!?" else sr.CUT
        seen.add((role, text))
        out.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + fault)
    return bytes(out)


def random_rows(r, n):
    return [(r.choice(["user", "assistant", "user", "assistant", "system", "x", ""]),
             r.choice([f"fine {r.random()}.", "again!", "cut off", "", " \n", f"cut {r.random()}"])) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 9, 31, 32, 33, 70])
def test_auction_is_the_cheapest_and_first_way(n):
    r = random.Random(n)
    for _ in range(150 if n < 20 else 8):
        rows = random_rows(r, n)
        assert cheapest(codes_of(rows)) == plain(rows)[4:6]


def test_prices_stay_feasible_and_become_distances():
    r = random.Random(3)
    codes = codes_of(random_rows(r, 20))
    arcs = sr.lattice(codes, None)
    prices = [0] * len(arcs)
    d = sr.auction(arcs, prices, 0)
    assert all(prices[i] <= c + prices[j] for i, out in enumerate(arcs) for _, j, c in out)
    letters, _ = sr.trace(arcs, prices, 0)
    assert d == prices[0] == cheapest(codes)[0] and letters == cheapest(codes)[1]


def plain_digest(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        by[c]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        by[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, ts in by.items():
        ts.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256((str(len(t[1])) + ":" + t[1] + t[2]).encode()).digest()))
        blank, dup, cut, illegal, cost, audit, turns = plain([t[1:] for t in ts])
        places = {t[0] for t in ts if t[0] is not None}
        gaps = max(places) - min(places) + 1 - len(places) if places else 0
        said = "\n".join(f"{r}:{t}" for r, t in turns)
        out[c] = (gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest())
    return out


def conversations(spark, rows):
    full = [(*x, "K", 1, i) for i, x in enumerate(rows)]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, edit string, place long, digest long").repartition(3)


def odd_rows():
    r = random.Random(11)
    rows = [(c, t, *x) for c in range(60) for t, x in enumerate(random_rows(r, r.randint(1, 12)))]
    rows += [(100, t * 3, *x) for t, x in enumerate(random_rows(r, 150))]
    rows += [(101, 5, "user", "same.")] * 4 + [(101, None, "system", None), (101, None, None, "x."), (102, 7, "user", "w. " * 40000)]
    rows += [(None, None, None, None), (None, 2, "user", "hi."), (None, 2, "assistant", "ho.")]
    rows += [(c, 0, "user", "alone.") for c in range(200, 260)]
    return rows


def test_digest_of_odd_conversations(spark):
    rows = odd_rows()
    got = {x.conv_id: tuple(x[1:]) for x in repair_digest(conversations(spark, rows)).collect()}
    want = plain_digest(rows)
    assert got == want
    assert any(not v[6] and not v[5] for v in want.values())          # some have lost all rows


def test_repaired_rows(spark):
    rows = [(1, t, *x) for t, x in enumerate(random_rows(random.Random(2), 40))]
    out = repair(conversations(spark, rows)).orderBy("place").collect()
    *edits, report = out
    assert report.edit is None and report.place == len(edits)
    want = plain([x[2:] for x in rows])
    assert "".join(e.edit for e in edits) == want[5] and report.cost == want[4]
    assert tuple((e.role, e.text) for e in edits if e.edit != "D") == want[6]


def test_empty_table(spark):
    none = conversations(spark, [(1, 1, "user", "x")]).limit(0)
    assert repair_digest(none).collect() == [] and repair(none).collect() == [] and damaged(none).collect() == []


def test_query_matches_its_sql(spark):
    import duckdb

    from fleetyard.llm.queries import ORACLE_SQL, QUERIES
    d = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    out = QUERIES["op12_structure_repair"](spark, d)
    want = duckdb.sql(ORACLE_SQL["op12_structure_repair"])
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(want.fetchall())
