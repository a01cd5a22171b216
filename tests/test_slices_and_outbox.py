"""Slice ledger, whole deliveries and versioned destination tables."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetyard.plans import jobs, slices
from fleetyard.plans.parts import parts_history
from fleetyard.plans.slices import SlicedJob, SliceRun
from fleetyard.sources import outbox
from fleetyard.sources import shared_files as files
from fleetyard.sources.versions import VersionedTable


@pytest.fixture
def home():
    return tempfile.mkdtemp(prefix="ledger-")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ slices
class Counting:
    """Parts history, cut as given; fails in the slices named."""

    def __init__(self, monkeypatch, fail=()):
        self.began, self.fail = [], set(fail)
        spec = slices.SLICED["pecas_historico"]

        def report(src, **kw):
            self.began.append(kw["ini"])
            df = spec.report(src, **kw)
            if kw["ini"] in self.fail:
                return df.withColumn("qtd_ocorrencias", F.raise_error(F.lit("lost")).cast("long"))
            return df

        monkeypatch.setitem(slices.SLICED, "pecas_historico", SlicedJob(report, spec.cut, spec.defaults, True))


def test_failed_slice_is_done_alone(small_src, home, monkeypatch):
    given = {"ini": 3650, "fim": 0, "slice_days": 900}
    bad = slices.by_days(given)[2]
    seen = Counting(monkeypatch, fail={bad[1]["ini"]})
    run = SliceRun.start(small_src, home, "pecas_historico", "r1", "2030-01-01", **given)
    with pytest.raises(Exception, match="lost"):
        run.work(small_src)
    assert len(seen.began) == 5 and [s[0] for s in run.missing()] == ["0002"] and not run.complete()
    with pytest.raises(ValueError, match="0002"):
        run.rows()
    seen.fail.clear()
    again = SliceRun.start(small_src, home, "pecas_historico", "r1", "2030-01-01", **given)
    assert again.work(small_src) == ["0002"] and len(seen.began) == 6
    assert again.work(small_src) == [] and again.complete()
    want = parts_history(small_src, "2030-01-01", 3650, 0, slice_days=900)
    got = again.rows().select(*want.columns)
    assert rows_of(got) == rows_of(want)
    assert again.tidy() == 1 and rows_of(again.rows().select(*want.columns)) == rows_of(want)


def test_slices_by_location_are_the_whole_report(small_src, home):
    run = SliceRun.start(small_src, home, "reservas_separacao", "r1")
    assert len(run.work(small_src, at_once=3)) == 6
    whole = jobs.build("reservas_separacao", small_src)
    assert rows_of(run.rows().select(*whole.columns)) == rows_of(whole)


def test_a_run_is_taken_up_only_as_it_was_begun(small_src, home):
    SliceRun.start(small_src, home, "pecas_historico", "r1", "2030-01-01", ini=90)
    with pytest.raises(ValueError, match="begun"):
        SliceRun.start(small_src, home, "pecas_historico", "r1", "2030-01-01", ini=180)
    with pytest.raises(TypeError):
        SliceRun.start(small_src, home, "pecas_historico", "r2", bogus=1)


def test_first_attempt_in_the_ledger_counts(spark, small_src, home):
    run = SliceRun.start(small_src, home, "pecas_historico", "r1", "2030-01-01", ini=3650, slice_days=3650)
    part = run.missing()[0]
    run._one(small_src, part)
    first = run.done()["0000"]
    run._one(small_src, part)                     # a second worker took the same slice
    assert run.done()["0000"] == first and len(files.names(spark, f"{run.folder}/data")) == 1


def test_records_are_written_once(spark, home):
    at = f"{home}/x/record.json"
    assert files.write_record(spark, at, {"a": "é"}) and not files.write_record(spark, at, {"a": 2})
    assert files.read_record(spark, at) == {"a": "é"} and files.names(spark, f"{home}/x") == ["record.json"]


# ------------------------------------------------------------------ deliveries
def payment(src):
    return jobs.build("pagamento_pedidos", src, "2030-01-01", ini=3650)


def test_delivery_is_whole_and_recognised(spark, small_src, home):
    order = [F.col("pedido")]
    sent = outbox.send(payment(small_src), home, "p", order, size=400)
    docs = [json.loads(r["json"]) for r in outbox.batches(spark, home, "p", sent.delivery).collect()]
    total = payment(small_src).count()
    assert sum(d["row_count"] for d in docs) == total and all(len(d["rows"]) == d["row_count"] for d in docs)
    assert {d["delivery"] for d in docs} == {sent.delivery} and sorted(d["batch"] for d in docs) == list(range(1, len(docs) + 1))
    keys = [r["pedido"] for d in sorted(docs, key=lambda d: d["batch"]) for r in d["rows"]]
    assert keys == sorted(keys)
    assert outbox.check(spark, home, "p", sent.delivery).collect() == []
    # the same rows in another order of computation: recognised, nothing written
    again = outbox.send(payment(small_src).repartition(13), home, "p", order, size=400)
    assert again == outbox.Sent(sent.delivery, sent.folder, True) and outbox.deliveries(spark, home, "p") == [sent.delivery]
    # one value less: another delivery
    other = outbox.send(payment(small_src).filter(F.col("pedido") != keys[0]), home, "p", order, size=400)
    assert not other.repeated and len(outbox.deliveries(spark, home, "p")) == 2


def test_delivery_that_fails_leaves_nothing(spark, small_src, home, monkeypatch):
    def lost(*a):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(outbox, "_manifest", lost)       # after the batches are written
        with pytest.raises(RuntimeError):
            outbox.send(payment(small_src), home, "p", [F.col("pedido")])
    assert outbox.deliveries(spark, home, "p") == [] and files.names(spark, f"{home}/p") == []
    one = payment(small_src).agg(F.max("pedido")).first()[0]
    broken = payment(small_src).withColumn("x", F.when(F.col("pedido") == one, F.raise_error(F.lit("lost"))).cast("string"))
    with pytest.raises(Exception, match="lost"):
        outbox.send(broken, home, "p", [F.col("pedido")])
    assert outbox.deliveries(spark, home, "p") == []
    assert not outbox.send(payment(small_src), home, "p", [F.col("pedido")]).repeated


def test_changed_and_missing_batches_are_found(spark, small_src, home):
    sent = outbox.send(payment(small_src), home, "p", [F.col("pedido")], size=500)
    good = outbox.batches(spark, home, "p", sent.delivery).collect()
    n = len(good)
    bad = [r for r in good if r["batch"] != 1]
    bad = [(r["batch"], r["row_count"], r["json"].replace("pedido", "pedidO") if r["batch"] == n else r["json"]) for r in bad]
    spark.createDataFrame(bad, "batch long, row_count long, json string").write.mode("overwrite").parquet(f"{sent.folder}/batches")
    assert sorted(map(tuple, outbox.check(spark, home, "p", sent.delivery).collect())) == [(1, "missing"), (n, "changed")]


def test_empty_report_is_a_delivery(spark, small_src, home):
    sent = outbox.send(payment(small_src).limit(0), home, "p", [F.col("pedido")])
    docs = [json.loads(r["json"]) for r in outbox.batches(spark, home, "p", sent.delivery).collect()]
    assert [(d["batch"], d["row_count"], d["rows"]) for d in docs] == [(1, 0, [])]
    assert outbox.send(payment(small_src).limit(0), home, "p", [F.col("pedido")]).repeated


# ------------------------------------------------------------------ versions
def test_versions_follow_the_report(spark, home):
    import random
    r = random.Random(8)
    t = VersionedTable.at(spark, f"{home}/t", ["k", "s"])
    state, history = {}, []
    for n in range(8):
        for _ in range(12):
            key = (r.choice(["a", "b", "c", None]), str(r.randint(0, 8)))
            if key in state and r.random() < 0.4:
                del state[key]
            else:
                state[key] = (None if r.random() < 0.2 else r.randint(0, 5), r.choice(["x", None]))
        df = spark.createDataFrame([(*k, *v) for k, v in state.items()], "k string, s string, v long, w string") \
            .withColumn("v", F.col("v").cast("decimal(10,2)"))
        before = history[-1] if history else []
        counts = t.merge(df, label=str(n))
        history.append(rows_of(df.selectExpr("k", "s", "v", "w")))
        old, new = ({x[:2]: x for x in h} for h in (before, history[-1]))
        assert counts == {"insert": len(new.keys() - old.keys()), "delete": len(old.keys() - new.keys()),
                          "update": sum(1 for k in new.keys() & old.keys() if new[k] != old[k])}
        if n == 4:
            assert t.compact() == 5
    assert [rows_of(t.read(v).select("k", "s", "v", "w")) for v in sorted(t.versions())] == history
    assert t.read().schema["v"].dataType.simpleString() == "decimal(10,2)"
    assert set(t.merge(t.read()).values()) == {0} and len(t.versions()) == 8      # no change, no version
    assert t.changes(8).count() == sum(t.versions()[8][k] for k in ("insert", "update", "delete"))


def test_merges_at_one_time_and_repeated_keys(spark, home, monkeypatch):
    t = VersionedTable.at(spark, f"{home}/t", ["k"])
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    t.merge(one)
    with pytest.raises(ValueError, match="several rows"):
        t.merge(one.union(one))
    with pytest.raises(ValueError, match="columns"):
        t.merge(one.withColumn("x", F.lit(1)))
    with pytest.raises(FileNotFoundError):
        t.read(9)
    monkeypatch.setattr(files, "write_record", lambda *a: False)       # somebody was first
    with pytest.raises(RuntimeError, match="meanwhile"):
        t.merge(one.limit(1))
    monkeypatch.undo()
    assert rows_of(t.read()) == rows_of(one) and len(files.names(spark, f"{t.path}/changes")) == 1


def test_verbs(small_src, home, capsys):
    from fleetyard.__main__ import main
    where = "testdata:" + os.environ.get("FLEETYARD_TEST_SF", "/root/testdata/sf0.001")
    assert main(["merge", "uca_patio", where, f"{home}/yard"]) == 0
    assert main(["merge", "uca_patio", where, f"{home}/yard"]) == 0
    assert main(["send", "pagamento_pedidos", where, f"{home}/out", "as_of=2030-01-01", "ini=3650"]) == 0
    assert main(["snapshot", "uca_patio", where, f"{home}/snap"]) == 0
    assert main(["slices", "pecas_historico", where, f"{home}/s", "id=1", "as_of=2030-01-01", "ini=3650", "slice_days=3650"]) == 0
    said = capsys.readouterr().out.splitlines()
    assert "'insert': 0" not in said[0] and said[1] == "{'insert': 0, 'update': 0, 'delete': 0}" and said[-1].endswith(": 1 slices")
    with pytest.raises(ValueError, match="no key"):
        jobs.merge("os_operacoes", small_src, f"{home}/x")
