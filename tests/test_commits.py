"""Commits and versions: two publishers, changed replays, hidden versions that come back."""

import threading

import pytest

from orderlake.config import scratch_path
from orderlake.plans import commits, publish
from orderlake.plans.publish import Warehouse, load_fact, manifest_entries, open_table
from orderlake.plans.versions import Parts
from tests.test_publish import _order, _rows_of, _versions


def _fact(spark, wh):
    return _rows_of(open_table(spark, wh, "fact_sales"))


def test_a_file_is_created_once(spark):
    path = scratch_path(spark, "once") + "/00.json"
    wins = []
    threads = [threading.Thread(target=lambda i=i: wins.append((commits.create_if_absent(spark, path, f"{i}\n"), i))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    won = [i for ok, i in wins if ok]
    assert len(wins) == 6 and len(won) == 1
    assert [r[0] for r in spark.read.text(path).collect()] == [str(won[0])]


def test_a_changed_replay_brings_the_older_version_back(spark):
    wh = Warehouse(scratch_path(spark, "changed-replay"))
    load_fact(spark, wh, _versions(spark, _order("o1", 10), _order("o2", 11)), "r0")
    load_fact(spark, wh, _versions(spark, _order("o1", 20)), "r1")
    assert _fact(spark, wh) == [("o1", 20.0), ("o2", 11.0)]
    load_fact(spark, wh, _versions(spark, _order("o3", 30)), "r1")  # r1 repeated without o1
    assert _fact(spark, wh) == [("o1", 10.0), ("o2", 11.0), ("o3", 30.0)]
    load_fact(spark, wh, _versions(spark, _order("o1", 5, "2024-01-01"), _order("o2", 12)), "r1")
    assert _fact(spark, wh) == [("o1", 10.0), ("o2", 12.0)]
    load_fact(spark, wh, _versions(spark).limit(0), "r0")  # r0 repeated with nothing
    assert _fact(spark, wh) == [("o1", 5.0), ("o2", 12.0)]


def test_loser_of_three_comes_back_when_both_winners_go(spark):
    wh = Warehouse(scratch_path(spark, "three"))
    for i, total in enumerate((10, 30, 20)):
        load_fact(spark, wh, _versions(spark, _order("o1", total)), f"r{i}")
    assert _fact(spark, wh) == [("o1", 30.0)]
    load_fact(spark, wh, _versions(spark, _order("x", 1)), "r1")
    assert _fact(spark, wh) == [("o1", 20.0), ("x", 1.0)]
    load_fact(spark, wh, _versions(spark, _order("x", 1)), "r2")
    assert _fact(spark, wh) == [("o1", 10.0), ("x", 1.0)]
    parts = Parts.of(manifest_entries(spark, wh), "fact_sales")
    assert sum(parts.live(p) for p in parts.data) == 2


def test_two_publishers_end_as_one_after_the_other(spark, monkeypatch):
    """The second publishes between the first one's merge and its commit; the first merges again."""
    wh = Warehouse(scratch_path(spark, "two"))
    load_fact(spark, wh, _versions(spark, _order("o1", 10), _order("o2", 10)), "r0")
    real, merges = publish.merge_fact, []

    def interrupted(spark_, wh_, staged, run_id, name="fact_sales"):
        out = real(spark_, wh_, staged, run_id, name)
        merges.append(run_id)
        if merges == ["a"]:
            load_fact(spark, wh, _versions(spark, _order("o1", 30), _order("o3", 5)), "b")
        return out

    monkeypatch.setattr(publish, "merge_fact", interrupted)
    publish.load_fact(spark, wh, _versions(spark, _order("o1", 20), _order("o2", 40)), "a")
    assert merges == ["a", "b", "a"]
    assert _fact(spark, wh) == [("o1", 30.0), ("o2", 40.0), ("o3", 5.0)]
    assert sorted({e[4] for e in manifest_entries(spark, wh)}) == [1, 2, 3]


def test_tables_made_before_another_commit_are_refused(spark):
    wh = Warehouse(scratch_path(spark, "stale"))
    load_fact(spark, wh, _versions(spark, _order("o1", 10)), "r0")
    with pytest.raises(commits.Conflict):
        publish._point(spark, wh, publish.Changes([("dim_region", "r1", "/nowhere", 1, None)], 0))
    # r0's part, its index and its partial: nothing of the refused commit
    assert sorted((e[0], e[1]) for e in manifest_entries(spark, wh)) == [
        ("fact_sales", "r0"), ("fact_sales/index", "r0"), ("fact_sales/partials", "r0")]
