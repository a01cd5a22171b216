"""Job runner: defaults, parameter overrides and batch documents."""
import json
import os
import tempfile

from fleetyard.plans import jobs


def test_every_job_builds(small_src):
    for name, job in jobs.JOBS.items():
        if job.style == "yard":
            continue
        params = {"ini": 3650} if "ini" in job.defaults and job.defaults["ini"] else {}
        df = jobs.build(name, small_src, as_of="2030-01-01", **params)
        assert df.columns, name


def test_run_writes_batches(spark, small_src):
    out = os.path.join(tempfile.mkdtemp(prefix="jobs-"), "out")
    first = jobs.run("pagamento_pedidos", small_src, out, as_of="2030-01-01", size=500, ini=3650)
    run = jobs.run("pagamento_pedidos", small_src, out, as_of="2030-01-01", size=500, ini=3650)
    assert first != run and os.path.isdir(first)              # an earlier delivery stays
    docs = [json.loads(line) for line in spark.read.text(run).toPandas()["value"]]
    total = jobs.build("pagamento_pedidos", small_src, "2030-01-01", ini=3650).count()
    assert sum(d["row_count"] for d in docs) == total
    assert sorted(d["batch"] for d in docs) == list(range(1, len(docs) + 1))
    assert all(d["total_rows"] == total and d["total_batches"] == len(docs) for d in docs)
    keys = [r["pedido"] for d in sorted(docs, key=lambda d: d["batch"]) for r in d["rows"]]
    assert keys == sorted(keys)


def test_day_slices_sum_to_unsliced_totals(small_src):
    from pyspark.sql import functions as F
    from fleetyard.plans.parts import parts_history
    sliced = parts_history(small_src, "2030-01-01", 3650, 0, slice_days=45)
    full = parts_history(small_src, "2030-01-01", 3650, 0)
    a = sliced.groupBy("ativo", "cod_sap").agg(F.round(F.sum("qtd_total"), 3).alias("q")).collect()
    b = full.select("ativo", "cod_sap", F.round("qtd_total", 3).alias("q")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_error_envelope_written_on_failure(spark, small_src, monkeypatch):
    import pytest
    out = os.path.join(tempfile.mkdtemp(prefix="jobs-"), "out")
    with pytest.raises(TypeError):
        jobs.run("pagamento_pedidos", small_src, out, as_of="2030-01-01", bogus=1)
    text = "x" * 5000

    def fails(*a, **k):
        raise ValueError(text)

    monkeypatch.setattr(jobs, "build", fails)
    with pytest.raises(ValueError):
        jobs.run("pagamento_pedidos", small_src, out)
    errors = [json.loads(spark.read.text(os.path.join(out, d)).collect()[0]["value"]) for d in os.listdir(out) if d.endswith("_error")]
    assert all(set(d) == {"started_at", "error"} for d in errors)
    assert any("bogus" in d["error"] for d in errors) and any(d["error"].endswith(text) for d in errors)


def read_run(spark, folder):
    return [json.loads(v) for v in spark.read.text(folder).toPandas()["value"]]


def test_delivered_values_and_columns(spark, small_src):
    out = os.path.join(tempfile.mkdtemp(prefix="jobs-"), "out")
    docs = read_run(spark, jobs.run("pecas_historico", small_src, out, as_of="2030-01-01", ini=3650))
    row = docs[0]["rows"][0]
    assert set(row) == {"ativo", "descricao_ativo", "cod_sap", "descricao_componente", "grupo_mercadoria", "qtd_ocorrencias",
                        "qtd_total", "ultima_ordem", "ultima_data"}
    assert isinstance(row["qtd_total"], str) and row["qtd_total"].count(".") == 1      # decimals are delivered as text
    hours = read_run(spark, jobs.run("horimetros", small_src, out))
    assert isinstance(hours[0]["rows"][0]["horimetro_sistema"], str)


def test_legacy_envelopes(spark, small_src):
    from fleetyard.sources.delivery import deliver
    from pyspark.sql import functions as F
    out = os.path.join(tempfile.mkdtemp(prefix="jobs-"), "many")
    many = spark.range(4500).select("id", (F.col("id") / 4).cast("decimal(10,2)").alias("q"))
    deliver(many, out, [F.col("id")], "x", "t0", style="legacy")
    docs = sorted(read_run(spark, out), key=lambda d: d["batch_index"])
    assert [len(d["rows"]) for d in docs] == [2000, 2000, 500]
    assert [d["is_last"] for d in docs] == [False, False, True] and docs[0]["rows"][1] == {"id": 1, "q": 0.25}
    deliver(many.filter("id < 0"), out + "0", [F.col("id")], "x", "t0", style="legacy")
    assert read_run(spark, out + "0") == [{"started_at": "t0", "rows": [], "is_last": True}]
    for job in ("pagamento_por_item", "recebimentos_por_pedido"):
        docs = read_run(spark, jobs.run(job, small_src, out + job))
        assert set(docs[0]) == {"started_at", "rows", "batch_index", "is_last"} and sum(d["is_last"] for d in docs) == 1
    doc, = read_run(spark, jobs.run("uca_payload", small_src, out + "yard", n_events=300))
    assert set(doc) == {"started_at", "rows", "eventos"} and len(doc["eventos"]) == 300


def test_rows_kept_for_numbering_are_removed(spark, small_src):
    from fleetyard.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = {d for d in os.listdir(folder) if d.startswith("delivery-")}
    jobs.run("horimetros", small_src, os.path.join(tempfile.mkdtemp(prefix="jobs-"), "o"))
    assert {d for d in os.listdir(folder) if d.startswith("delivery-")} == before


def test_yard_payload_document(spark, small_src):
    from fleetyard.plans.yard import yard_payload, yard_snapshot
    doc = json.loads(yard_payload(small_src, "2030-01-01T00:00:00+00:00").collect()[0]["json"])
    rows, events = yard_snapshot(small_src)
    assert len(doc["eventos"]) == events.count() and len(doc["rows"]) == rows.count()
    ts = [e["ts"] for e in doc["eventos"]]
    assert ts == sorted(ts, reverse=True)
    assert set(doc["rows"][0]) == set(rows.columns)
    assert all(e["horimetro"] is None or isinstance(e["horimetro"], str) for e in doc["eventos"])
    small = json.loads(yard_payload(small_src, "t", 50).collect()[0]["json"])
    assert small["eventos"] == doc["eventos"][:50]


def test_front_end(spark, capsys):
    from fleetyard.__main__ import main
    assert main(["jobs"]) == 0
    assert "reservas_separacao" in capsys.readouterr().out
    out = os.path.join(tempfile.mkdtemp(prefix="cli-"), "out")
    assert main(["run", "horimetros", "testdata:/root/testdata/sf0.001", out]) == 0
    docs = read_run(spark, capsys.readouterr().out.strip())
    assert docs and docs[0]["job"] == "horimetros"
    assert main(["run", "no such job", "testdata:x", out]) == 2


def test_snapshot_keeps_decimals(spark, small_src):
    out = os.path.join(tempfile.mkdtemp(prefix="snap-"), "horimetros")
    first, second = (jobs.snapshot("horimetros", small_src, out) for _ in range(2))
    assert first != second
    got = spark.read.parquet(first)
    assert dict(got.dtypes)["horimetro_sistema"].startswith("decimal")
    assert got.count() == jobs.build("horimetros", small_src).count()
