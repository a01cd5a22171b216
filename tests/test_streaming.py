"""The streaming yard state equals the batch report."""
import os
import tempfile

from pyspark.sql import functions as F

from fleetyard.plans.yard import yard_current
from fleetyard.streaming import current_yard, in_yard, latest_event_per_asset, start


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_aggregate_form_matches_batch(spark, small_src):
    ev = small_src.table("relatorio_entrada_saida_uca")
    got = in_yard(latest_event_per_asset(ev))
    assert _rows(got.select(*yard_current(small_src).columns)) == _rows(yard_current(small_src))


def test_stream_in_two_arrivals_matches_batch(spark, small_src):
    ev = small_src.table("relatorio_entrada_saida_uca")
    root = tempfile.mkdtemp(prefix="yard-stream-")
    src_dir, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    # first arrival: older half of the ids; second arrival: the rest
    ev.filter(F.col("id") < 500).write.parquet(f"{src_dir}/part1")
    q = start(spark, f"{src_dir}/*", ev.schema, sink, ckpt)
    q.awaitTermination()
    ev.filter(F.col("id") >= 500).write.parquet(f"{src_dir}/part2")
    q = start(spark, f"{src_dir}/*", ev.schema, sink, ckpt)
    q.awaitTermination()
    got = current_yard(spark, sink)
    want = yard_current(small_src)
    assert _rows(got.select(*want.columns)) == _rows(want)


def test_compacted_log_is_the_same_and_small(spark, small_src):
    import glob

    from fleetyard.streaming.yard_state import compact
    ev = small_src.table("relatorio_entrada_saida_uca")
    root = tempfile.mkdtemp(prefix="yard-stream-")
    src_dir, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    for n in range(4):
        ev.filter(F.col("id") % 4 == n).write.parquet(f"{src_dir}/part{n}")
        start(spark, f"{src_dir}/*", ev.schema, sink, ckpt).awaitTermination()
        if n in (1, 3):
            before = _rows(current_yard(spark, sink))
            compact(spark, sink)
            assert _rows(current_yard(spark, sink)) == before
            assert compact(spark, sink) >= 0                       # nothing new: the same state
    want = yard_current(small_src)
    assert _rows(current_yard(spark, sink).select(*want.columns)) == _rows(want)
    assert not glob.glob(f"{sink}/batch_id=*") and len(glob.glob(f"{sink}/_state/*")) == 1
    kept = spark.read.parquet(*glob.glob(f"{sink}/_state/*"))
    assert kept.count() == kept.select("n_armac").distinct().count()


class Arrivals:
    """The yard events as they are at one poll."""

    def __init__(self, src, events):
        self.src, self.spark, self.events = src, src.spark, events

    def table(self, name):
        return self.events if name == "relatorio_entrada_saida_uca" else self.src.table(name)


def arrivals(src, steps=4, overlap=400):
    """Events up to a number; of the newest, some are late, wrong at first, or withdrawn later."""
    ev = src.table("relatorio_entrada_saida_uca")
    low, high = ev.agg(F.min("id"), F.max("id")).first()
    for i in range(1, steps + 1):
        top = low + (high - low) * i // steps
        young = F.col("id") > top - overlap // 2 if i < steps else F.lit(False)
        now = ev.filter(F.col("id") <= top).filter(~(young & (F.col("id") % 5 == 0)))
        now = now.withColumn("tipo_relatorio", F.when(young & (F.col("id") % 7 == 0), "Entrada").otherwise(F.col("tipo_relatorio")))
        now = now.withColumn("created_at_form", F.when(young & (F.col("id") % 11 == 0), F.col("created_at_form") + F.expr("INTERVAL 9 YEARS"))
                             .otherwise(F.col("created_at_form")))
        if i < steps:
            ghost = ev.filter((F.col("id") > top - overlap // 2) & (F.col("id") % 13 == 0) & (F.col("id") <= top)).withColumns(
                {"id": F.col("id") + F.lit(0), "n_armac": F.concat(F.lit("GHOST"), F.col("id").cast("string"))})
            now = now.filter(~(young & (F.col("id") % 13 == 0))).unionByName(ghost)
        yield Arrivals(src, now)


def test_polls_with_late_corrected_and_withdrawn_events(spark, small_src):
    import glob

    from fleetyard.operators.keyed import latest_by
    from fleetyard.streaming.polling import YardPoll, _events, _order
    root = tempfile.mkdtemp(prefix="yard-poll-")
    poll = YardPoll(spark, root, overlap=400)
    marks = []
    for now in arrivals(small_src):
        marks.append(poll.poll(now)["mark"])
        want = latest_by(_events(now), "asset", _order())
        assert _rows(poll.winners().select(*want.columns)) == _rows(want)
    want = yard_current(small_src)
    assert _rows(poll.current().select(*want.columns)) == _rows(want)
    assert marks == sorted(marks) and poll.poll(small_src)["mark"] == marks[-1]
    assert len(glob.glob(f"{root}/state/*")) == 2                  # this poll and the one before
    recent = spark.read.parquet(f"{poll.last()['folder']}/recent")
    assert recent.count() <= 400
