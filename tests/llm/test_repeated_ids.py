"""Rows of one id, or of none, are dealt over cells like any others."""

import pytest

from ledgerlight.llm import mixing


@pytest.mark.parametrize("hot", [None, 7])
def test_no_cell_grows_with_an_id(spark, tmp_path, monkeypatch, hot):
    inner = mixing._cell

    def bounded(land, seed):
        run = inner(land, seed)

        def checked(rows):
            assert len(rows) <= 200, f"{len(rows)} rows in one cell"
            return run(rows)
        return checked
    monkeypatch.setattr(mixing, "_cell", bounded)
    rows = [(hot if i % 3 == 0 else i, "w " * (i % 40 + 1), "ab"[i % 2]) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "t"))
    out = mixing.mix(spark, spark.read.parquet(str(tmp_path / "t")), cell=50).toPandas()
    assert len(out) == len(rows) and out.rid.is_unique
    by = out.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 60).all()
