"""Slices of a run read the source once."""
import os
import tempfile

from fleetyard.plans.parts import parts_history
from fleetyard.plans.slices import SliceRun


class Reads:
    """A source that counts how often a table is asked for."""

    def __init__(self, src):
        self.src, self.spark, self.n = src, src.spark, {}

    def table(self, name):
        self.n[name] = self.n.get(name, 0) + 1
        return self.src.table(name)


def test_slices_share_one_pass_over_the_source(small_src):
    home, src = tempfile.mkdtemp(prefix="shared-"), Reads(small_src)
    run = SliceRun.start(src, home, "pecas_historico", "r1", "2030-01-01", ini=3650, slice_days=900)
    assert len(run.work(src)) == 5
    assert src.n["resb"] == src.n["aufk"] == src.n["afih"] == 1
    assert not os.listdir(f"{run.folder}/shared")
    want = parts_history(small_src, "2030-01-01", 3650, 0, slice_days=900)
    got = run.rows().select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
