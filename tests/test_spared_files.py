"""Reloads leave the stored files alone of which their slice deletes nothing."""
import datetime as dt
import os

import pytest

from ledgerlight.operators import slices as S
from ledgerlight.session import scratch_path

SCHEMA = "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_DISCIPLINA string, VAL int"


def _load(spark, table, rows, disciplines, **more):
    df = spark.createDataFrame([("P", day and dt.date.fromisoformat(day), d, v) for day, d, v in rows], SCHEMA).coalesce(1)
    return S.reload_slice(spark, table, df, "P", disciplines, S.MONTH, **more)


def _files(table):
    table = table.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), table) for d, _, names in os.walk(table) for f in names if f.endswith(".parquet")}


def _rows(spark, table):
    return sorted((str(r.DAT_REFERENCIA), r.NOM_DISCIPLINA, r.VAL) for r in S.read_table(spark, table).collect())


A = [("2024-01-05", "A", 1), ("2024-02-06", "A", 2), ("2024-03-07", "A", 3), (None, "A", 4)]
B = [("2024-01-05", "B", 5), ("2024-03-09", "B", 6), (None, "B", 7)]


@pytest.fixture
def table(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL_FILE", 0, raising=False)
    table = scratch_path(spark, "test-spared")
    _load(spark, table, A, ["A"])
    return table


def test_files_of_other_disciplines_stay(spark, table):
    first = _files(table)
    _load(spark, table, B, ["B"])
    both = _files(table)
    assert len(first) == 4 and len(both) == 7 and first < both
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in A + B)
    _load(spark, table, [("2024-01-20", "B", 8), ("2024-03-20", "B", 9)], ["B"])          # deletes the 9th of March only
    now = _files(table)
    assert first < now and len(now) == 8 and len(now & both) == 6                        # the four of A, B's of January and its undated one
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in [*A, B[0], B[2], ("2024-01-20", "B", 8), ("2024-03-20", "B", 9)])


def test_a_month_that_gets_no_row_loses_only_the_files_of_the_slice(spark, table):
    _load(spark, table, [(f"2024-0{m}-0{m}", "B", m) for m in (1, 2, 3)], ["B"])
    before = _files(table)
    _load(spark, table, [("2024-01-01", "B", 10), ("2024-03-31", "B", 11)], ["B"])
    assert {f for f in _files(table) if "2024-02" in f} == {f for f in before if "2024-02" in f} - _of(spark, table, before, "B")
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in [*A, ("2024-01-01", "B", 10), ("2024-03-31", "B", 11)])


def _of(spark, table, files, discipline):
    """Files that are gone, or hold that discipline."""
    here = {f for f in files if os.path.exists(f"{table.removeprefix('file:')}/{f}")}
    return (files - here) | {f for f in here if spark.read.parquet(f"{table}/{f}").filter(f"NOM_DISCIPLINA = '{discipline}'").count()}


def test_a_file_with_a_row_of_the_slice_is_written_again(spark, table):
    _load(spark, table, [("2024-01-10", "A", 20), ("2024-01-11", "A", 21)], ["A"])        # spares the 5th, in a file of its own
    files = _files(table)
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in [*A, ("2024-01-10", "A", 20), ("2024-01-11", "A", 21)])
    _load(spark, table, [("2024-01-11", "A", 22)], ["A"])                                # the 10th lies in the file of the 11th
    assert len(files & _files(table)) == 4 and len(files) == 5
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in [*A, ("2024-01-10", "A", 20), ("2024-01-11", "A", 22)])


@pytest.mark.parametrize("at", ["first", "carried"])
def test_a_stopped_publication_is_completed(spark, table, monkeypatch, at):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    work_off = S._work_off

    def stops(spark, table_dir, staged, todo):
        if at == "carried":
            fs, root = S._fs(spark, table_dir)
            name = min(todo["carry"])
            for f in todo["carry"][name]:
                assert fs.rename(path(path(root, name), f), path(path(staged, name), f))
            fs.delete(path(root, name), True)
        raise OSError("stopped")

    monkeypatch.setattr(S, "_work_off", stops)
    with pytest.raises(OSError, match="stopped"):
        _load(spark, table, B, ["B"])
    monkeypatch.setattr(S, "_work_off", work_off)
    assert S.recover(spark, table) == 1 and len(_files(table)) == 7
    assert _rows(spark, table) == sorted((str(d), n, v) for d, n, v in A + B)


def test_small_files_are_merged_and_finish_reads_all(spark, table, monkeypatch):
    _load(spark, table, B, ["B"], finish=lambda rows: rows.withColumn("VAL", rows.VAL + 100))
    assert _rows(spark, table) == sorted((str(d), n, v + 100) for d, n, v in A + B)
    monkeypatch.setattr(S, "SMALL_FILE", 1 << 20)
    _load(spark, table, [("2024-02-01", "B", 1), ("2024-02-02", "B", 2)], ["B"])
    assert len([f for f in _files(table) if "2024-02" in f]) == 1
