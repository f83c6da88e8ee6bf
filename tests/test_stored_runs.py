"""Stored incremental runs, key-indexed upserts and compaction: crashes, replays, odd keys and partitions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import incremental as inc
from ledgerline.plans import incremental_job as ij
from ledgerline.sinks import compaction, key_index
from ledgerline.sinks.compaction import CompactionParams

KIND = "transaction_id string, day string, updated_at timestamp_ntz, v int"


def _at(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), KIND)


def _table(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(KIND).parquet(path).select("transaction_id", "day", "v").collect()), key=str)


# ---- I4: upsert by key index ---------------------------------------------------------

def test_three_reruns_give_equal_tables_and_null_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    inc.upsert(spark, path, _rows(spark, ("a", "01", _at(1), 1), ("b", "2", _at(1), 1), ("c", None, _at(1), 1)), "day", exists=False)
    updates = _rows(spark, ("a", "2", _at(2), 2), ("d", None, _at(2), 2), ("d", None, _at(3), 3))
    want = [("a", "2", 2), ("b", "2", 1), ("c", None, 1), ("d", None, 3)]
    for _ in range(3):
        inc.upsert(spark, path, updates, "day")
        assert _table(spark, path) == want
    with pytest.raises(inc.NullKeyError, match="1 of 2"):
        inc.upsert(spark, path, _rows(spark, (None, "2", _at(4), 9), ("b", "2", _at(4), 9)), "day")
    assert _table(spark, path) == want
    merged = inc.merge_frames(_rows(spark, ("b", "2", _at(1), 1)), _rows(spark, (None, "2", _at(4), 9), ("b", "2", _at(4), 9)))
    assert [r["v"] for r in merged.collect()] == [9]


def test_upsert_reads_the_index_and_touched_partitions_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    inc.upsert(spark, path, _rows(spark, *[(f"k{i}", f"d{i % 10}", _at(1), 0) for i in range(200)]), "day", exists=False)
    scopes = []
    stage_rows = inc.stage_rows
    monkeypatch.setattr(inc, "stage_rows", lambda s, df, by: scopes.append(df) or stage_rows(s, df, by))
    inc.upsert(spark, path, _rows(spark, ("k3", "d7", _at(2), 5)), "day")
    # the rewritten scope lists the files of the key's old and new day alone
    days = {f.split("day=")[1].split("/")[0] for f in scopes[0].inputFiles() if "day=" in f}
    plan = scopes[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "d3" in plan and "d7" in plan
    for other in days - {"d3", "d7"}:
        assert f"day={other}" not in plan
    found = dict((r["transaction_id"], (r["day"], r["v"])) for r in spark.read.schema(KIND).parquet(path).collect())
    assert found["k3"] == ("d7", 5) and len(found) == 200
    # the lookup reads the index, pruned to the updates' buckets, and nothing of the table
    held = key_index.read(spark, key_index.index_path(path), spark.createDataFrame([], KIND).schema["day"].dataType)
    assert {r["part"] for r in held.where(F.col("key_hash") == F.xxhash64(F.lit("k3"))).collect()} == {"d3", "d7"}
    assert all(key_index.index_path(path) in f for f in held.inputFiles())


def test_a_missing_index_is_built_from_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    _rows(spark, ("a", "1", _at(1), 1), ("b", "2", _at(1), 1)).write.partitionBy("day").parquet(path)
    inc.upsert(spark, path, _rows(spark, ("a", "2", _at(2), 2)), "day")
    assert _table(spark, path) == [("a", "2", 2), ("b", "2", 1)] and not os.path.exists(f"{path}/day=1")


# ---- I3, I5: the stored run ---------------------------------------------------------

class Crash(Exception):
    pass


def _source(spark, rows, reads):
    def read():
        reads.append(1)
        return _rows(spark, *rows)
    return read


FIRST = [("a", "1", _at(1), 1), ("b", "1", _at(2), 1), ("c", "2", _at(3), 1)]
SECOND = FIRST + [("a", "2", _at(5), 2), ("d", "3", _at(4), 1), (None, "3", _at(4), 7)]
AFTER = [("a", "2", 2), ("b", "1", 1), ("c", "2", 1), ("d", "3", 1)]


def _break(monkeypatch, where):
    """Make the job die right before or after one step."""
    when, name = where.split()
    real = getattr(ij, name)

    def broken(*args, **kw):
        if when == "in":  # the target is changed halfway: some of it is gone
            spark, job, _ = args
            for d in sorted(os.listdir(job.target_path)):
                if d.startswith("day="):
                    for f in os.listdir(f"{job.target_path}/{d}"):
                        os.remove(f"{job.target_path}/{d}/{f}")
                    break
        elif when == "after":
            real(*args, **kw)
        raise Crash(name)

    monkeypatch.setattr(ij, name, broken)


@pytest.mark.parametrize("where", ["before stage", "after stage", "before prepare", "after prepare", "before publish", "in publish", "after publish"])
def test_a_run_resumes_after_a_crash(spark, tmp_path, monkeypatch, where):
    job, reads = ij.Job(str(tmp_path / "t"), "day"), []
    ij.run(spark, job, _source(spark, FIRST, reads), _at(6))
    assert _table(spark, job.target_path) == [("a", "1", 1), ("b", "1", 1), ("c", "2", 1)]
    with monkeypatch.context() as m:
        _break(m, where)
        with pytest.raises(Crash):
            ij.run(spark, job, _source(spark, SECOND, reads), _at(7))
    stored = ij.marks(ij.read_ledger(spark, job)).collect()
    assert [r["last_processed_ts"] for r in stored] == [_at(3)]  # no commit, no mark
    before = len(reads)
    got = ij.run(spark, job, _source(spark, SECOND, reads), _at(8))
    assert got["run_no"] == 2 and got["mark"] == _at(5) and got["extracted"] == 4  # c again by the grace period
    assert len(reads) - before == ("stage" in where)  # staged rows are not read twice
    assert _table(spark, job.target_path) == AFTER
    assert [r["last_processed_ts"] for r in ij.marks(ij.read_ledger(spark, job)).collect()] == [_at(5)]
    lost = spark.read.schema(KIND).parquet(f"{job.target_path}_quarantine").collect()
    assert [(r["transaction_id"], r["v"]) for r in lost] == [(None, 7)]


def test_a_crash_of_the_first_run_and_runs_without_news(spark, tmp_path, monkeypatch):
    job, reads = ij.Job(str(tmp_path / "t"), "day"), []
    got = ij.run(spark, job, _source(spark, [], reads), _at(5))
    assert got["extracted"] == 0 and not os.path.exists(job.target_path)
    with monkeypatch.context() as m:
        _break(m, "after publish")
        with pytest.raises(Crash):
            ij.run(spark, job, _source(spark, FIRST, reads), _at(6))
    assert ij.run(spark, job, _source(spark, FIRST, reads), _at(6))["run_no"] == 2
    for _ in range(2):
        got = ij.run(spark, job, _source(spark, FIRST, reads), _at(7))
        assert got["extracted"] == 1 and got["mark"] == _at(3)  # the grace period's row, and the mark stays
        assert _table(spark, job.target_path) == [("a", "1", 1), ("b", "1", 1), ("c", "2", 1)]
    other = ij.Job(job.target_path, "day", params=inc.IncrementalParams(source_system="cards"))
    ij.run(spark, other, _source(spark, [("z", "9", _at(2), 1)], reads), _at(9))
    assert {r["source_system"]: r["last_processed_ts"] for r in ij.marks(ij.read_ledger(spark, job)).collect()} == {"core_banking_extract": _at(3), "cards": _at(2)}
    assert _table(spark, job.target_path)[-1] == ("z", "9", 1)


# ---- B12: compaction ------------------------------------------------------------------

def _fragmented(spark, path, times=3):
    rows = [(f"k{i}", ["01", "1", None, "u/v w:%=x"][i % 4], _at(1), i) for i in range(200)]
    for n in range(times):
        spark.createDataFrame(rows[n::times], KIND).coalesce(2).write.mode("append").partitionBy("day").parquet(path)
    return rows


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and not f.startswith(".")}


def test_compaction_keeps_rows_and_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = _fragmented(spark, path)
    folders = {os.path.dirname(f) for f in _files(path)}
    assert len(_files(path)) == 24 and len(folders) == 4
    want = sorted(((r[0], r[1], r[3]) for r in rows), key=str)
    got = compaction.compact(spark, path)
    assert got["files_before"] == 24 and got["files_after"] == 4 and got["rows"] == 200
    assert _table(spark, path) == want and {os.path.dirname(f) for f in _files(path)} == folders
    after = _files(path)
    assert compaction.compact(spark, path)["files_before"] == 0 and _files(path) == after  # nothing rewritten
    spark.createDataFrame([("new", "01", _at(1), 0)], KIND).write.mode("append").partitionBy("day").parquet(path)
    assert compaction.compact(spark, path)["files_before"] == 2  # the new file and the one of its folder
    assert _table(spark, path) == sorted(want + [("new", "01", 0)], key=str)


def test_compaction_bins_by_bytes_without_reading_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    _fragmented(spark, path, times=6)
    size = max(os.path.getsize(f) for f in _files(path))
    planned = compaction.plan(spark, path, CompactionParams(target_bytes=3 * size, small=0.9))
    assert "content" not in planned._jdf.queryExecution().executedPlan().toString()
    bins = {}
    for r in planned.collect():
        bins.setdefault((r["dir"], r["nth"]), []).append(r["length"])
    assert all(len(b) > 1 and sum(b[:-1]) < 3 * size for b in bins.values()) and len(bins) > 4
    assert compaction.plan(spark, path, CompactionParams(target_bytes=size // 2)).count() == 0  # none is small


@pytest.mark.parametrize("step", ["rename", "delete"])
def test_an_interrupted_swap_is_finished(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    want = sorted(((r[0], r[1], r[3]) for r in _fragmented(spark, path)), key=str)
    real, calls = compaction.file_system, []

    def failing(s, p):
        fs, q = real(s, p)

        class Fs:
            def __getattr__(self, name):
                def call(*args):
                    calls.append(name)
                    if calls.count(step) == 3 and name == step:
                        raise Crash
                    return getattr(fs, name)(*args)
                return call
        return Fs(), q

    with monkeypatch.context() as m:
        m.setattr(compaction, "file_system", failing)
        with pytest.raises(Crash):
            compaction.compact(spark, path)
    got = compaction.compact(spark, path)
    assert _table(spark, path) == want and got["files_before"] == 0 and len(_files(path)) == 4
    assert os.listdir(compaction.journal_path(path)) == []


def test_compaction_of_nothing_and_of_staging_left_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    _fragmented(spark, path, times=1)
    os.makedirs(f"{compaction.journal_path(path)}/run=dead/files")
    assert compaction.recover(spark, path) == 0 and os.listdir(compaction.journal_path(path)) == []
    compaction.compact(spark, path)
    assert compaction.compact(spark, path) == {"files_before": 0, "files_after": 0, "bytes": 0, "rows": 0}
