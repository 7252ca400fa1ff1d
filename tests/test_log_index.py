from pathlib import Path

import pytest
from helpers import rows

from ordertide.sources import record_log as log
from ordertide.sources.log_index import LogIndex


def records(spark, low, high, late=0):
    """Two partitions of one topic, time rising by a second an offset; ``late`` ones are out of order."""
    data = [("t", p, i, 1_700_000_000_000 + 1000 * i - (late if i % 10 == 3 else 0), f"{p}-{i}") for p in (0, 1) for i in range(low, high)]
    return spark.createDataFrame(data, "topic string, partition int, offset bigint, timestamp bigint, value string").coalesce(1)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("logs")
    path = str(tmp_path / "a log%20")
    for k in range(10):
        records(spark, 100 * k, 100 * k + 100, late=150_000 if k == 6 else 0).write.mode("append").parquet(path)
    out = LogIndex(spark, path, str(tmp_path / "index"))
    assert out.refresh() == 10 and out.refresh() == 0
    return out


def at(offset):
    return 1_700_000_000 + offset


@pytest.mark.parametrize("t", [0, 1, at(0), at(437), at(500), at(560), at(599), at(600), at(999), at(1000), at(5000)])
def test_answers_are_those_of_the_whole_log(spark, index, t):
    whole = spark.read.parquet(index.log_path)
    assert sorted(rows(index.offsets_for_time(t))) == sorted(rows(log.offsets_for_time(whole, t)))
    assert sorted(rows(index.seek_from_time(t))) == sorted(rows(log.seek_from_time(whole, t)))


def test_seeks_by_offset(spark, index):
    whole = spark.read.parquet(index.log_path)
    for offsets in (0, 250, 5000, [None, 730], [900, -1], [5, 990]):
        assert sorted(rows(index.seek(offsets))) == sorted(rows(log.seek(whole, offsets)))
    assert sorted(rows(index.last_offsets())) == sorted(rows(log.last_offsets(whole)))


def test_unneeded_files_are_not_scanned(spark, index):
    assert len(index.seek(950).inputFiles()) == 1
    assert len(index.seek([None, 730]).inputFiles()) == 3
    of_log = lambda df: [f for f in df.inputFiles() if "a%20log" in f]
    assert len(of_log(index.seek_from_time(at(899)))) == 2
    # File 4 straddles the time, and file 6 holds records from before it.
    assert len(of_log(index.offsets_for_time(at(460)))) == 1


def test_a_log_without_records(spark, tmp_path):
    records(spark, 0, 0).write.parquet(str(tmp_path / "log"))
    index = LogIndex(spark, str(tmp_path / "log"), str(tmp_path / "index"))
    index.refresh()
    assert rows(index.offsets_for_time(at(5))) == [] and rows(index.seek_from_time(at(5))) == []


def test_new_files_and_files_that_are_gone(spark, index):  # the last test of this log, as it changes it
    records(spark, 1000, 1100).write.mode("append").parquet(index.log_path)
    assert index.refresh() == 1
    assert {r["last_offset"] for r in index.last_offsets().collect()} == {1100}
    oldest = min(Path(index.log_path).glob("*.parquet"), key=lambda p: p.stat().st_mtime)
    oldest.unlink()
    assert index.seek(0).count() == 2000
    assert sorted(rows(index.offsets_for_time(at(0)))) == [("t", 0, 100), ("t", 1, 100)]
