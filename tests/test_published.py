"""A published write is seen whole or not at all."""

import threading

import pytest
from helpers import collect, row, summary
from pyspark.sql import functions as F

from returns_analytics import schemas
from returns_analytics.errors import PublishConflict
from returns_analytics.sources.files import Folder
from returns_analytics.sources.published import Published


@pytest.fixture
def store(spark, tmp_path):
    return Published(spark, f"{tmp_path}/table")


def rows_of(store, periods=None):
    return collect(store.read(schemas.SUMMARY, periods), "gstin", "ret_period")


def frame(spark, *rows):
    return summary(spark, [row(gstin, period, taxable_value=1) for gstin, period in rows])


def test_only_its_periods_are_replaced(spark, store):
    assert rows_of(store) == []
    store.publish(frame(spark, ("A", "012000"), ("B", "022000")))
    store.publish(frame(spark, ("C", "022000")))
    assert rows_of(store) == [("A", "012000"), ("C", "022000")]
    assert rows_of(store, ["022000", "031999"]) == [("C", "022000")]
    # a table may be written over itself, and a period may be emptied
    changed = store.read(schemas.SUMMARY).filter("gstin = 'A'").withColumn("gstin", F.lit("D"))
    store.publish(changed, periods=["022000"])
    assert rows_of(store) == [("D", "012000")]
    assert store.read(schemas.SUMMARY).schema == schemas.SUMMARY


def test_a_period_filter_reads_one_folder(spark, store):
    store.publish(frame(spark, ("A", "012000"), ("B", "022000")))
    plan = store.read(schemas.SUMMARY).filter("ret_period = '012000'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ret_period" in plan


def test_a_write_killed_half_way_leaves_the_old_period(spark, store):
    store.publish(frame(spark, ("A", "012000"), ("B", "012000"), ("C", "022000")))
    before, folders = rows_of(store), sorted(Folder(spark, store.path).names())
    many = frame(spark, *[(str(k), "012000") for k in range(50)]).repartition(10, "gstin")
    # some tasks write their files, another one fails
    failing = many.withColumn("gstin", F.when(F.col("gstin") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("gstin")))
    with pytest.raises(Exception, match="lost"):
        store.publish(failing)
    assert rows_of(store) == before and sorted(Folder(spark, store.path).names()) == folders


def test_a_driver_lost_before_the_rename_leaves_the_old_period(spark, store, monkeypatch):
    store.publish(frame(spark, ("A", "012000")))

    def lost(self, name, text):
        raise KeyboardInterrupt

    monkeypatch.setattr(Folder, "create", lost)
    monkeypatch.setattr(Folder, "delete", lambda self, name: None)  # nor does it come to clean up
    with pytest.raises(KeyboardInterrupt):
        store.publish(frame(spark, ("B", "012000")))
    monkeypatch.undo()
    assert rows_of(store) == [("A", "012000")]
    store.publish(frame(spark, ("C", "012000")))
    assert rows_of(store) == [("C", "012000")]


def test_two_writers(spark, store, monkeypatch):
    """The second one builds on the first if it has other periods, and stops if it has the same."""
    store.publish(frame(spark, ("A", "012000")))
    inner = Published._point

    def late(self, base, written, gone):
        monkeypatch.setattr(Published, "_point", inner)
        store.publish(frame(spark, ("B", "022000")))
        return inner(self, base, written, gone)

    monkeypatch.setattr(Published, "_point", late)
    store.publish(frame(spark, ("C", "032000")))
    assert rows_of(store) == [("A", "012000"), ("B", "022000"), ("C", "032000")]
    monkeypatch.setattr(Published, "_point", late)
    with pytest.raises(PublishConflict):
        store.publish(frame(spark, ("D", "022000")))
    assert ("B", "022000") in rows_of(store)


def test_a_taken_number_is_not_replaced(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append((folder.create("_state/1.json", str(k)), k))) for k in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(ok for ok, _ in won) == [False] * 5 + [True]
    assert [n for n in folder.names("_state") if not n.startswith(".")] == ["1.json"] and folder.create("_state/1.json", "x") is False
    assert folder.read("_state/1.json") in {str(k) for ok, k in won if ok}


def test_a_rename_does_not_replace_either(spark, tmp_path):
    """The way of shared file systems, on what the local one gives."""
    folder = Folder(spark, str(tmp_path))
    (tmp_path / "a").write_text("a")
    (tmp_path / "b").write_text("b")
    assert folder._rename(folder._system(), "a", "c") is True and folder._rename(folder._system(), "b", "c") is False
    assert folder.read("c") == "a"


def test_cleaning_keeps_what_the_pointers_name(spark, store):
    for gstin in "ABC":
        store.publish(frame(spark, (gstin, "012000")))
    store.publish(frame(spark, ("X", "022000")))
    assert len(store.clean(keep=2)) == 2
    assert rows_of(store) == [("C", "012000"), ("X", "022000")]
    assert store.clean() == [] and store.publish(frame(spark, ("Y", "022000"))).number == 5
