"""The pipeline's stages against what their operators say, and run() against the stages; the repository without the subpackage."""

import os
import re
import shutil
import subprocess
import sys

import corpus_pipeline
from ledgerlight.llm import decontam, quality
from ledgerlight.llm.common import table
from ledgerlight.llm.simhash import simhash_groups

MIDDLE = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_take_effect_on_what_came_before(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "decontamination", "secrets", "mixing"] and corpus_pipeline.ORACLE_SQL is None
    kept, docs = {}, table(spark, MIDDLE, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, MIDDLE).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        assert docs.columns[:len(columns)] == columns and (name == "mixing" or docs.columns == columns)
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in kept.items()}
    scored = quality.classify(spark, table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")).filter("predicted = 1")
    assert ids["quality"] == {r.doc_id for r in scored.collect()}
    groups = simhash_groups(spark, kept["quality"]).toPandas()
    assert ids["near_copies"] == set(groups.component_id)
    hits = decontam.contaminated(spark, kept["near_copies"], table(spark, MIDDLE, "benchmark"))
    assert ids["decontamination"] == ids["near_copies"] - {r.doc_id for r in hits.select("doc_id").collect()}
    assert ids["secrets"] == ids["decontamination"]
    assert not [r for r in kept["secrets"].collect() if re.search(r'token = "[0-9a-f]{40}', r.text)]
    assert [r for r in kept["decontamination"].collect() if re.search(r'token = "[0-9a-f]{40}', r.text)]
    assert ids["mixing"] <= ids["secrets"] and {r.mix_copies for r in kept["mixing"].collect()} <= {1, 2}
    run = corpus_pipeline.run(spark, MIDDLE).toPandas()
    one = kept["mixing"].toPandas()
    key = ["doc_id", "text", "mix_copies"]
    assert run.sort_values("doc_id")[key].values.tolist() == one.sort_values("doc_id")[key].values.tolist()


def test_the_rest_imports_without_the_subpackage(tmp_path):
    away = tmp_path / "repo"
    shutil.copytree(ROOT, away, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not [k for k in q if k[2:3].isdigit()], q"
    subprocess.run([sys.executable, "-c", code], cwd=away, check=True, env=os.environ | {"PYTHONPATH": str(away)})
